"""The BI marts as SQL text over catalog views, with bound parameters.

``spark.sql(text, args={"limit": n})`` binds ``:limit`` (no string pasting of
values); identifiers are fixed view names. The texts aggregate the fact
before the dimension join, as the DataFrame marts do, and add a key
tie-break to every top-k order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

BI_SQL = {
    "sales_summary": """
SELECT count(*) AS total_orders, coalesce(sum(quantity), 0) AS total_quantity,
       coalesce(CAST(sum(total_amount) AS DOUBLE), 0.0) AS total_revenue,
       coalesce(try_divide(CAST(sum(total_amount) AS DOUBLE), count(total_amount)), 0.0) AS avg_order_value,
       coalesce(CAST(sum(discount) AS DOUBLE), 0.0) AS total_discount
FROM fact_sales""",
    "customer_summary": """
SELECT count(*) AS total_customers, count(DISTINCT city) AS cities, count(DISTINCT country) AS countries
FROM dim_customers""",
    "product_summary": """
SELECT count(*) AS total_products, count(DISTINCT category) AS categories, count(DISTINCT brand) AS brands,
       try_divide(CAST(sum(price) AS DOUBLE), count(price)) AS avg_price
FROM dim_products""",
    "top_customers": """
SELECT c.customer_id, c.customer_name, c.city, c.country, coalesce(f.n, 0) AS order_count,
       CAST(f.rev AS DOUBLE) AS total_revenue
FROM dim_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(total_amount) AS rev FROM fact_sales GROUP BY customer_id) f
  ON c.customer_id = f.customer_id
ORDER BY total_revenue DESC NULLS LAST, c.customer_id
LIMIT :limit""",
    "top_products": """
SELECT p.product_id, p.product_name, p.category, p.brand, coalesce(f.n, 0) AS sales_count,
       f.qty AS total_quantity_sold, CAST(f.rev AS DOUBLE) AS total_revenue
FROM dim_products p
LEFT JOIN (SELECT product_id, count(*) AS n, sum(quantity) AS qty, sum(total_amount) AS rev
           FROM fact_sales GROUP BY product_id) f
  ON p.product_id = f.product_id
ORDER BY total_revenue DESC NULLS LAST, p.product_id
LIMIT :limit""",
    "daily_sales": """
SELECT to_date(created_at) AS date, count(*) AS order_count, sum(quantity) AS total_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       try_divide(CAST(sum(total_amount) AS DOUBLE), count(total_amount)) AS avg_order_value
FROM fact_sales GROUP BY to_date(created_at) ORDER BY date""",
    "category_performance": """
SELECT p.category, coalesce(sum(f.n), 0) AS sales_count, sum(f.qty) AS total_quantity,
       CAST(sum(f.rev) AS DOUBLE) AS total_revenue,
       try_divide(CAST(sum(f.rev) AS DOUBLE), coalesce(sum(f.n), 0)) AS avg_order_value
FROM dim_products p
LEFT JOIN (SELECT product_id, count(*) AS n, sum(quantity) AS qty, sum(total_amount) AS rev
           FROM fact_sales GROUP BY product_id) f
  ON p.product_id = f.product_id
GROUP BY p.category ORDER BY total_revenue DESC NULLS LAST, p.category""",
}

VIEWS = ("fact_sales", "dim_customers", "dim_products")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name in VIEWS:
        if name in tables:
            tables[name].createOrReplaceTempView(name)


def run_bi_sql(spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None,
               limit: int = 10) -> DataFrame:
    if tables:
        register_views(tables)
    text = BI_SQL[name]
    return spark.sql(text, args={"limit": limit}) if ":limit" in text else spark.sql(text)
