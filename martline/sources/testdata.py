"""Adapter from the TPC-H-style driver tables to the sales model.

The sales model has three sources: ``orders`` (one row per order line),
``customers`` and ``products``. Every mapping below is a plain projection /
equi-join, so the same rows can be produced by the DuckDB oracle text in
``martline.plans.oracle_sql`` (keep both in step).

Fixed mapping (sales column <- driver expression):
  order_id      <- l_orderkey           line_number <- l_linenumber
  supplier_id   <- l_suppkey            customer_id <- o_custkey
  product_id    <- l_partkey            order_date  <- o_orderdate
  shipped_at    <- l_shipdate           quantity    <- int(l_quantity)
  unit_price    <- round-half-up cents of l_extendedprice / l_quantity, DECIMAL(10,2)
  discount      <- l_discount as a percent with 2 decimals, DECIMAL(5,2) (as in the sample CSV)
  customer_name <- c_name               email       <- '  ' || upper(c_name) || '@Example.com '
  city          <- n_name               country     <- r_name
  product_name  <- p_name               category    <- p_type
  brand         <- p_brand              price       <- p_retailprice as DECIMAL(10,2)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ORDER_COLUMNS = ["order_id", "line_number", "supplier_id", "customer_id", "product_id",
                 "order_date", "shipped_at", "quantity", "unit_price", "discount"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "city", "country"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "brand", "price"]


_READERS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame; the reader (file listing, footer schema)
    is built once per session and path - the tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: lineitem joined to its order header (both large: shuffle join)."""
    return order_lines(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def order_lines(li: DataFrame, o: DataFrame) -> DataFrame:
    """Order lines from the two tables; where both are bucketed by the order key, without a shuffle."""
    o = o.select("o_orderkey", "o_custkey", "o_orderdate")
    # Integer cents / basis points times a DECIMAL(2,2) literal keep the decimals
    # long-backed (precision <= 18); a DOUBLE -> DECIMAL cast goes through BigDecimal.
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity") + 0.5)
    bps = F.floor(F.col("l_discount") * 10000 + 0.5)
    hundredth = F.lit(Decimal("0.01"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (cents.cast("decimal(10,0)") * hundredth).cast("decimal(10,2)").alias("unit_price"),
        (bps.cast("decimal(7,0)") * hundredth).cast("decimal(5,2)").alias("discount"),
    )


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation as city and region as country (dimension-sized joins)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_name").alias("customer_name"),
                     F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.com ")).alias("email"),
                     F.col("n_name").alias("city"),
                     F.col("r_name").alias("country")))


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.col("p_brand").alias("brand"),
                    (F.floor(F.col("p_retailprice") * 100 + 0.5).cast("decimal(10,0)")
                     * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("price"))


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders source as a raw feed with a data-driven gap: a zero discount
    is "not recorded" (NULL). Exercises null profiling, completeness, fills."""
    o = orders_source(spark, sf_dir)
    return o.withColumn("discount", F.when(F.col("discount") != 0, F.col("discount")))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events where an ``error`` event carries no measured value (NULL)."""
    e = events_source(spark, sf_dir)
    return e.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
