"""BI marts over the star schema.

Join shape (J7): the fact is aggregated by its dimension key first (partial
aggregation map-side, so a hot customer/product collapses before the
shuffle), then the dimension is LEFT JOINed to the small aggregate. That keeps
dimension members without sales (count 0, revenue NULL, sorted last).

Money is summed as DECIMAL and cast once to DOUBLE; averages are
``sum / count`` in DOUBLE, i.e. an average per fact row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.session import scratch_path

DEFAULT_TOP_K = 10


def _money(c) -> F.Column:
    return c.cast("double")


def _avg(total, count) -> F.Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def sales_summary(fact: DataFrame) -> DataFrame:
    """One row: total_orders, total_quantity, total_revenue, avg_order_value, total_discount.
    An empty fact gives the all-zero row."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0).cast("long")).alias("total_quantity"),
        F.coalesce(_money(F.sum("total_amount")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(_avg(F.sum("total_amount"), F.count("total_amount")), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(_money(F.sum("discount")), F.lit(0.0)).alias("total_discount"),
    )


def _distinct(c: str, approx: bool) -> F.Column:
    return F.approx_count_distinct(c, 0.01) if approx else F.count_distinct(c)


def customer_summary(dim_customers: DataFrame, approx: bool = False) -> DataFrame:
    """A4; ``approx=True`` uses HyperLogLog++ instead of exact distinct counts."""
    return dim_customers.agg(F.count(F.lit(1)).alias("total_customers"),
                             _distinct("city", approx).alias("cities"),
                             _distinct("country", approx).alias("countries"))


def product_summary(dim_products: DataFrame, approx: bool = False) -> DataFrame:
    return dim_products.agg(F.count(F.lit(1)).alias("total_products"),
                            _distinct("category", approx).alias("categories"),
                            _distinct("brand", approx).alias("brands"),
                            _avg(F.sum("price"), F.count("price")).alias("avg_price"))


def _fact_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n"),
                                 F.sum("quantity").alias("__qty"),
                                 F.sum("total_amount").alias("__rev"))


def top_customers(dim_customers: DataFrame, fact: DataFrame, limit: int = DEFAULT_TOP_K) -> DataFrame:
    return _top_customers(dim_customers, _fact_by(fact, "customer_id"), limit)


def _top_customers(dim_customers: DataFrame, agg: DataFrame, limit: int) -> DataFrame:
    j = dim_customers.join(agg, "customer_id", "left")
    return (j.select("customer_id", "customer_name", "city", "country",
                     F.coalesce("__n", F.lit(0).cast("long")).alias("order_count"),
                     _money(F.col("__rev")).alias("total_revenue"))
             .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("customer_id"))
             .limit(limit))


def top_products(dim_products: DataFrame, fact: DataFrame, limit: int = DEFAULT_TOP_K) -> DataFrame:
    return _top_products(dim_products, _fact_by(fact, "product_id"), limit)


def _top_products(dim_products: DataFrame, agg: DataFrame, limit: int) -> DataFrame:
    j = dim_products.join(agg, "product_id", "left")
    return (j.select("product_id", "product_name", "category", "brand",
                     F.coalesce("__n", F.lit(0).cast("long")).alias("sales_count"),
                     F.col("__qty").alias("total_quantity_sold"),
                     _money(F.col("__rev")).alias("total_revenue"))
             .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id"))
             .limit(limit))


def daily_sales(fact: DataFrame, date_column: str = "created_at") -> DataFrame:
    """Per day of ``date_column``: order_count, total_quantity, total_revenue, avg_order_value."""
    return (fact.groupBy(F.to_date(date_column).alias("date"))
                .agg(F.count(F.lit(1)).alias("order_count"),
                     F.sum("quantity").alias("total_quantity"),
                     _money(F.sum("total_amount")).alias("total_revenue"),
                     _avg(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"))
                .orderBy("date"))


def category_performance(dim_products: DataFrame, fact: DataFrame) -> DataFrame:
    return _category_performance(dim_products, _fact_by(fact, "product_id"))


def _category_performance(dim_products: DataFrame, agg: DataFrame) -> DataFrame:
    j = dim_products.select("product_id", "category").join(agg, "product_id", "left")
    out = j.groupBy("category").agg(
        F.coalesce(F.sum("__n"), F.lit(0).cast("long")).alias("sales_count"),
        F.sum("__qty").alias("total_quantity"),
        F.sum("__rev").alias("__rev"))
    return (out.select("category", "sales_count", "total_quantity",
                       _money(F.col("__rev")).alias("total_revenue"),
                       _avg(F.col("__rev"), F.col("sales_count")).alias("avg_order_value"))
               .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last()))


def category_share(dim_products: DataFrame, fact: DataFrame) -> DataFrame:
    """Each category's share of revenue. The total is a window over the categories' sums (one row a category), so the
    fact is aggregated once and nothing runs before the query does."""
    agg = _fact_by(fact, "product_id")
    cat = (dim_products.select("product_id", "category").join(agg, "product_id", "left")
           .groupBy("category").agg(F.sum("__rev").alias("__rev")))
    total = F.sum("__rev").over(Window.partitionBy(F.lit(1))).cast("double")
    return cat.select("category", _money(F.col("__rev")).alias("total_revenue"),
                      F.try_divide(_money(F.col("__rev")), total).alias("revenue_share"))


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table (sorted by name) with its row count and the grand total."""
    if not tables:
        raise ValueError("no tables")
    return _table_stats({n: df.agg(F.count(F.lit(1)).alias("row_count")) for n, df in tables.items()})


def _table_stats(counts: Mapping[str, DataFrame]) -> DataFrame:
    names = sorted(counts)
    parts = [counts[n].select(F.lit(n).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per table: the total is a window over a handful of rows
    return (out.withColumn("total_records", F.sum("row_count").over(Window.partitionBy(F.lit(1))))
               .orderBy("table_name"))


#: Grouping ids of the sets of ``fact_sums``: a bit is 1 where customer_id, product_id, date is summed over.
ALL, BY_CUSTOMER, BY_PRODUCT, BY_DATE = 0b111, 0b011, 0b101, 0b110


def fact_sums(fact: DataFrame, date_column: str = "created_at") -> DataFrame:
    """What all marts need of the fact, in one read of it: counts and sums by customer, by product, by day and over all
    (grouping sets, told apart by ``__set``), written once. As large as these three keys, not as the fact."""
    spark = fact.sparkSession
    f = fact.select("customer_id", "product_id", F.to_date(date_column).alias("date"), "quantity", "total_amount", "discount")
    keys = [F.col("customer_id"), F.col("product_id"), F.col("date")]
    sums = f.groupingSets([[], [keys[0]], [keys[1]], [keys[2]]], *keys).agg(
        F.grouping_id().cast("int").alias("__set"), F.count(F.lit(1)).alias("__n"), F.sum("quantity").alias("__qty"), F.sum("total_amount").alias("__rev"),
        F.count("total_amount").alias("__paid"), F.sum("discount").alias("__discount"))
    path = scratch_path(spark, "fact-sums")
    sums.write.partitionBy("__set").parquet(path)
    return spark.read.schema(sums.schema).parquet(path)


def all_marts(tables: Mapping[str, DataFrame], limit: int = DEFAULT_TOP_K) -> dict[str, DataFrame]:
    """A10: every mart from one set of star tables; the fact is read once (``fact_sums``)."""
    dc, dp = tables["dim_customers"], tables["dim_products"]
    sums = fact_sums(tables["fact_sales"])
    total, by_product = sums.where(F.col("__set") == ALL), sums.where(F.col("__set") == BY_PRODUCT).select("product_id", "__n", "__qty", "__rev")
    counts = {n: df.agg(F.count(F.lit(1)).alias("row_count")) for n, df in tables.items() if n != "fact_sales"}
    counts["fact_sales"] = total.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        "stats": _table_stats(counts),
        "sales_summary": total.agg(  # at most one row; none for an empty fact
            F.coalesce(F.sum("__n"), F.lit(0)).alias("total_orders"), F.coalesce(F.sum("__qty"), F.lit(0).cast("long")).alias("total_quantity"),
            zero(_money(F.sum("__rev"))).alias("total_revenue"), zero(_avg(F.sum("__rev"), F.sum("__paid"))).alias("avg_order_value"),
            zero(_money(F.sum("__discount"))).alias("total_discount")),
        "customer_summary": customer_summary(dc),
        "product_summary": product_summary(dp),
        "top_customers": _top_customers(dc, sums.where(F.col("__set") == BY_CUSTOMER).select("customer_id", "__n", "__rev"), limit),
        "top_products": _top_products(dp, by_product, limit),
        "daily_sales": sums.where(F.col("__set") == BY_DATE).select(
            "date", F.col("__n").alias("order_count"), F.col("__qty").alias("total_quantity"), _money(F.col("__rev")).alias("total_revenue"),
            _avg(F.col("__rev"), F.col("__paid")).alias("avg_order_value")).orderBy("date"),
        "category_performance": _category_performance(dp, by_product),
    }


def month_key(date_id: str) -> F.Column:
    """yyyymm of a yyyymmdd key: a partition column with few folders."""
    return F.floor(F.col(date_id) / 100).cast("int")


def period_sales(fact: DataFrame, dim_date: DataFrame, period: F.Column) -> DataFrame:
    """Sales by year, quarter and month of the days for which ``period`` (a condition on ``dim_date``) holds.

    ``fact`` is partitioned by ``month_id`` (``month_key``). The filtered dimension is joined by month and day, so its
    months decide at run time which folders of the fact are read."""
    days = dim_date.where(period).select("date_id", "year", "quarter", "month", month_key("date_id").alias("month_id"))
    return (fact.join(days, ["month_id", "date_id"]).groupBy("year", "quarter", "month")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("quantity").alias("total_quantity"), _money(F.sum("total_amount")).alias("total_revenue")))
