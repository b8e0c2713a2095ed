"""BI marts: members without sales, NULL categories, empty fact (FIXTURES §4)."""

from decimal import Decimal

from martline.plans import marts
from martline.plans.marts_sql import run_bi_sql

FACT = "sale_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, total_amount DECIMAL(10,2), discount DECIMAL(10,2), created_at TIMESTAMP_NTZ"


def _star(spark):
    dc = spark.createDataFrame([(1, "a", "x", "X"), (2, "b", "y", "X"), (3, "c", "y", "Y")],
                               "customer_id BIGINT, customer_name STRING, city STRING, country STRING")
    dp = spark.createDataFrame([(10, "p", "cat1", "b1", Decimal("1.00")), (11, "q", None, "b2", Decimal("2.00")),
                                (12, "r", "cat2", "b1", None)],
                               "product_id BIGINT, product_name STRING, category STRING, brand STRING, price DECIMAL(10,2)")
    import datetime as dt
    f = spark.createDataFrame([(1, 1, 10, 2, Decimal("5.00"), Decimal("0.50"), dt.datetime(2024, 1, 1)),
                               (2, 1, 11, 1, Decimal("3.00"), None, dt.datetime(2024, 1, 2)),
                               (3, 2, 10, 4, Decimal("9.00"), Decimal("0"), dt.datetime(2024, 1, 2))], FACT)
    return dc, dp, f


def test_no_sales_members_kept_last(spark):
    dc, dp, f = _star(spark)
    top = [(r.customer_id, r.order_count, r.total_revenue) for r in marts.top_customers(dc, f).collect()]
    assert top == [(2, 1, 9.0), (1, 2, 8.0), (3, 0, None)]
    cats = [(r.category, r.sales_count, r.total_revenue) for r in marts.category_performance(dp, f).collect()]
    assert cats == [("cat1", 2, 14.0), (None, 1, 3.0), ("cat2", 0, None)]
    sql = [(r.customer_id, r.order_count, r.total_revenue)
           for r in run_bi_sql(spark, "top_customers", {"fact_sales": f, "dim_customers": dc}, limit=2).collect()]
    assert sql == top[:2]


def test_empty_fact_summary_is_zero_row(spark):
    dc, dp, f = _star(spark)
    s = marts.sales_summary(f.limit(0)).collect()
    assert [tuple(r) for r in s] == [(0, 0, 0.0, 0.0, 0.0)]
    p = marts.product_summary(dp).first()
    assert (p.total_products, p.categories, p.brands, p.avg_price) == (3, 2, 2, 1.5)
    d = [(str(r.date), r.order_count) for r in marts.daily_sales(f).collect()]
    assert d == [("2024-01-01", 1), ("2024-01-02", 2)]
