"""Sales transform (X1) and the star schema (dim_customers, dim_products,
dim_date, fact_sales).

Decimal contract: money inside the model is DECIMAL (exact sums);
``unit_price``/``total_amount``/``discount`` in the fact are DECIMAL(10,2) as
in the warehouse DDL. ``fact_sales.discount`` stores the discount *amount*
(the source ``discount`` is a percent). Keys are BIGINT (the DDL's INTEGER
would overflow at large scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.operators.calc import calculate_fields
from martline.operators.joins import enrich_with_lookup, join_data
from martline.operators.ordered import global_row_number

# The derived-field expressions of the sales transform.
SALES_CALCULATIONS = {
    "total_amount": "quantity * unit_price",
    "discount_amount": "total_amount * discount / 100",
    "final_amount": "total_amount - discount_amount",
}
PRODUCT_LOOKUP_COLUMNS = ["product_name", "category", "brand", "price"]

MONEY_TYPES = {"total_amount": "decimal(18,2)", "discount_amount": "decimal(18,4)",
               "final_amount": "decimal(18,4)"}

FACT_COLUMNS = ["sale_id", "customer_id", "product_id", "date_id", "quantity", "unit_price",
                "total_amount", "discount", "created_at"]
SALE_ORDER = ["order_id", "line_number", "product_id", "supplier_id"]


def add_sales_amounts(orders: DataFrame) -> DataFrame:
    """The three derived money columns, evaluated in order, then fixed to the contract types."""
    df = calculate_fields(orders, SALES_CALCULATIONS)
    return df.withColumns({c: F.col(c).cast(t) for c, t in MONEY_TYPES.items()})


def transform_sales(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders LEFT JOIN customers, LEFT JOIN products[name, category, brand, price]
    with prefix ``product_``, then total / discount / final amounts."""
    df = join_data(orders, customers, "customer_id", "customer_id", how="left")
    df = enrich_with_lookup(df, products, "product_id", "product_id", PRODUCT_LOOKUP_COLUMNS,
                            prefix="product")
    return add_sales_amounts(df)


def date_key(c) -> F.Column:
    """yyyyMMdd integer key of a date/timestamp column."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def fact_sales(sales: DataFrame, with_sale_id: bool = True, created_at: str = "shipped_at",
               first_id: int = 1, dense_ids: bool = True, copy_to: str | None = None) -> DataFrame:
    """Fact rows from order lines carrying the sales amounts.

    ``sale_id`` (SERIAL) follows order-line order. ``dense_ids=True`` numbers
    1..n exactly (one range shuffle + a reliable checkpoint of the tagged rows,
    i.e. the fact is written twice; ``copy_to`` names a folder for compressed files
    in its place, which the caller deletes). ``dense_ids=False`` is one pass for very
    large loads: ids are unique and increasing in the same order but with gaps
    between partitions (as a sequence has after rollbacks); they are stable
    under task retries because each partition is sorted before numbering.
    BI marts do not need ``sale_id`` and skip all of this.
    """
    if "total_amount" not in sales.columns:
        sales = add_sales_amounts(sales)
    keep = [c for c in SALE_ORDER if c in sales.columns and c != "product_id"]
    fact = sales.select(
        *keep, "customer_id", "product_id",
        date_key("order_date").alias("date_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
        F.col("discount_amount").cast("decimal(10,2)").alias("discount"),
        F.col(created_at).alias("created_at"),
    )
    if with_sale_id and not dense_ids:
        order = [c for c in SALE_ORDER if c in fact.columns]
        n = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fact = (fact.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("sale_id", F.monotonically_increasing_id() + F.lit(first_id)))
        return fact.select(*FACT_COLUMNS)
    if with_sale_id:
        order = [c for c in SALE_ORDER if c in fact.columns]
        fact = global_row_number(fact, order, "sale_id", columns=[c for c in FACT_COLUMNS if c != "sale_id"], copy_to=copy_to)
        if first_id != 1:
            fact = fact.withColumn("sale_id", F.col("sale_id") + F.lit(first_id - 1))
        return fact.select(*FACT_COLUMNS)
    return fact.select(*[c for c in FACT_COLUMNS if c != "sale_id"])


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("customer_id").cast("long"), "customer_name", "email", "city", "country")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(F.col("product_id").cast("long"), "product_name", "category", "brand",
                           F.col("price").cast("decimal(10,2)").alias("price"))


def dim_date(dates: DataFrame, column: str) -> DataFrame:
    """Every calendar day between the first and last date of ``column``.

    The day span (not the data size) bounds the one generated row set.
    Attributes: year, quarter, month, ISO week, day_of_week (Monday = 0).
    """
    span = dates.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        date_key("date").alias("date_id"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), F.weekofyear("date").alias("week"),
        ((F.dayofweek("date") + 5) % 7).alias("day_of_week"),
    )
