"""Goldens on the reference's sample rows (FIXTURES.md section 3)."""

import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martline.operators.aggregate import aggregate_daily_sales
from martline.plans import marts, star
from martline.plans.batch_job import Inputs, JobConfig, Publishing, SalesJob, run_job
from martline.plans.warehouse import Warehouse
from martline.session import SHUFFLE_CLEANUP, checkpoint_root, short_lived_shuffles
from martline.sources import files
from tests import sample_data as S
from tests.helpers import tmpdir, write


def _sources(spark):
    d = tmpdir()
    o = files.extract_csv(spark, write(d, "orders.csv", S.ORDERS_CSV), schema=S.ORDERS_SCHEMA)
    c = files.extract_json(spark, write(d, "customers.json", S.CUSTOMERS_JSON))
    p = files.extract_json_nested(spark, write(d, "products.json", S.PRODUCTS_JSON), record_path="products")
    return o, c, p


def test_sales_transform_golden(spark):
    o, c, p = _sources(spark)
    x = star.transform_sales(o, c, p)
    got = [(r.order_id, r.total_amount, r.discount_amount, r.final_amount)
           for r in x.orderBy("order_id").collect()]
    assert [(a, b, d.normalize(), e.normalize()) for a, b, d, e in got] == \
           [(a, b, d.normalize(), e.normalize()) for a, b, d, e in S.X1_GOLDEN]
    sums = x.agg(F.sum("total_amount"), F.sum("discount_amount"), F.sum("final_amount")).first()
    assert tuple(sums) == S.X1_SUMS
    assert "product_product_name" in x.columns and "customer_name" in x.columns
    assert x.where("customer_id = 101").select("city").first()[0] == "Hà Nội"


def test_daily_sales_golden(spark):
    o, c, p = _sources(spark)
    d = aggregate_daily_sales(star.transform_sales(o, c, p)).orderBy("date").collect()
    assert [(str(r.date), r.quantity_sum, r.total_amount_sum, r.final_amount_sum.normalize(), r.order_count)
            for r in d] == [(a, b, c_, e.normalize(), f) for a, b, c_, e, f in S.DAILY_GOLDEN]


def test_marts_golden(spark):
    o, c, p = _sources(spark)
    sales = star.transform_sales(o, c, p).withColumn("shipped_at", F.col("order_date").cast("timestamp_ntz"))
    fact = star.fact_sales(sales, with_sale_id=True)
    dc, dp = star.dim_customers(c), star.dim_products(p)
    top = marts.top_customers(dc, fact).collect()
    assert [(r.customer_id, r.total_revenue, r.order_count) for r in top] == S.TOP_CUSTOMERS
    cats = {r.category: (r.total_revenue, r.sales_count, r.total_quantity)
            for r in marts.category_performance(dp, fact).collect()}
    assert cats == S.CATEGORIES
    s = marts.sales_summary(fact).first()
    assert (s.total_orders, s.total_quantity, s.total_revenue) == (10, 20, 538.8)
    assert sorted(r.sale_id for r in fact.collect()) == list(range(1, 11))
    share = {r.category: r.revenue_share for r in marts.category_share(dp, fact).collect()}
    assert abs(sum(share.values()) - 1.0) < 1e-12


def _job(orders, **options):
    d = tmpdir()
    inputs = Inputs(write(d, "orders.csv", orders), write(d, "customers.json", S.CUSTOMERS_JSON), write(d, "products.json", S.PRODUCTS_JSON),
                    orders_schema=S.ORDERS_SCHEMA)
    return JobConfig(inputs=inputs, warehouse=f"{d}/wh", lake=f"{d}/lake", **options)


def test_batch_job_end_to_end(spark):
    cfg = _job(S.ORDERS_CSV)
    res = run_job(spark, cfg)
    assert res.ok and res.names("done") == ["read", "land", "check", "clean", "enrich", "store", "publish"]
    counted = res.rows()
    assert [counted[f"land.{t}"] for t in ("orders", "customers", "products")] == [10, 5, 6]
    assert counted["store.cleaned"] == counted["store.rows"] == counted["publish.fact_sales"] == 10
    wh = Warehouse(spark, cfg.warehouse)
    assert wh.read("fact_sales").count() == 10
    stats = {r.table_name: r.row_count for r in wh.table_stats().collect()}
    assert stats == {"dim_customers": 5, "dim_products": 6, "dim_date": 5, "fact_sales": 10}
    top = marts.top_customers(wh.read("dim_customers"), wh.read("fact_sales")).first()
    assert (top.customer_id, top.total_revenue) == (102, 204.94)
    # the same files again add nothing; another run id does, with new surrogate keys
    again = run_job(spark, cfg)
    assert again.ok and again.run_id == res.run_id
    assert Warehouse(spark, cfg.warehouse).read("fact_sales").count() == 10
    cfg.run_id = "another"
    assert run_job(spark, cfg).ok
    f = Warehouse(spark, cfg.warehouse).read("fact_sales")
    assert f.count() == 20 and f.agg(F.countDistinct("sale_id")).first()[0] == 20
    assert Warehouse(spark, cfg.warehouse).read("dim_customers").count() == 5


def test_a_jobs_scratch_data_is_small_and_short_lived(spark):
    def kept():  # shuffles of ended queries, folders of checkpoints and copies
        env, root = spark._jvm.org.apache.spark.SparkEnv.get(), Path(checkpoint_root(spark).removeprefix("file:"))
        files_ = list(env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
        return {f for f in files_ if "/shuffle_" in f} | {str(d) for d in [*root.glob("rdd-*"), *root.glob("martline/*/*")]}

    twice = S.ORDERS_CSV + S.ORDERS_CSV.split("\n", 1)[1]
    cfg = _job(twice, publishing=Publishing(dense_ids=True))
    job = SalesJob(spark, cfg)
    before, res = kept(), job.run()
    until = time.monotonic() + 10  # files go in the background
    while kept() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert kept() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) is None
    assert [res.rows()[k] for k in ("land.orders", "store.cleaned", "publish.fact_sales")] == [20, 10, 10]
    f = Warehouse(spark, cfg.warehouse).read("fact_sales").orderBy("sale_id").collect()
    assert [r.sale_id for r in f] == list(range(1, 11)) and f[0].customer_id == 101 and f[9].product_id == 206
    # rows without copies are not shuffled for them
    job = SalesJob(spark, _job(S.ORDERS_CSV))
    job.read(), job.land(), job.clean()
    assert "Aggregate" not in job.frames["orders"]._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError), short_lived_shuffles(spark):
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_batch_job_validation_gate(spark):
    bad = S.ORDERS_CSV.replace("1,101,201,2024-01-15,2,", "1,101,201,2024-01-15,0,")
    with pytest.raises(ValueError, match=r"business_rule\(quantity\)"):
        run_job(spark, _job(bad))
    res = run_job(spark, _job(bad, go_on=True))
    assert res.names("failed") == ["check"] and res.ok       # the later stages ran
    gone = _job(S.ORDERS_CSV, go_on=True, run_id="x")
    gone.inputs.orders += ".gone"
    res = run_job(spark, gone)
    assert not res.ok and res.names("failed") == ["read"] and "no CSV file" in res.stages[0].error


def test_batch_job_scale_layouts(spark):
    cfg = _job(S.ORDERS_CSV, publishing=Publishing(dimension_buckets=4, partition_by=["date_id"]))
    assert run_job(spark, cfg).ok
    assert run_job(spark, cfg).ok          # second run: bucketed dims upsert in place
    wh = Warehouse(spark, cfg.warehouse)
    assert wh.read("dim_customers").count() == 5 and wh._layout("dim_customers") == (["customer_id"], 4)
    f = wh.read("fact_sales")
    assert f.count() == 10 and "date_id" in f.columns
    assert f.where("date_id = 20240115").count() == 2
    top = marts.top_customers(wh.read("dim_customers"), f).first()
    assert (top.customer_id, top.total_revenue) == (102, 204.94)


def test_sparse_surrogate_ids_are_unique_and_ordered(spark):
    o, c, p = _sources(spark)
    sales = star.add_sales_amounts(o).withColumn("shipped_at", F.col("order_date").cast("timestamp_ntz"))
    ids = [r.sale_id for r in star.fact_sales(sales, dense_ids=False, first_id=100).collect()]
    dense = star.fact_sales(sales).orderBy("sale_id").collect()
    sparse = star.fact_sales(sales, dense_ids=False).orderBy("sale_id").collect()
    assert len(set(ids)) == 10 and min(ids) >= 100
    assert [r.total_amount for r in dense] == [r.total_amount for r in sparse]   # same order


def test_validation_report_in_the_lake(spark):
    cfg = _job(S.ORDERS_CSV.replace("1,101,201,2024-01-15,2,", "1,101,201,2024-01-15,0,"), go_on=True, publishing=None)
    res = run_job(spark, cfg)
    assert res.as_dict()["failed_checks"] == ["business_rule:quantity"]
    from martline.sources.lake import DataLake
    saved = DataLake(spark, cfg.lake).latest("processed", "validation_report")
    assert saved.where("check = 'business_rule' AND column = 'quantity'").first().value == 1.0
