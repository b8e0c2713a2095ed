"""Plans and odd cases: one read of the fact, run-time pruning, bucketed joins, custom aggregates, lists, rejects, outliers, lineage."""

import datetime as dt
import math
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from martline.functions import aggregates as reg
from martline.functions.json import unnest
from martline.operators import quality
from martline.operators.aggregate import aggregate_custom, aggregate_data
from martline.operators.ordered import fill_ordered
from martline.plans import lineage, marts, registry, star
from martline.plans.warehouse import Warehouse
from martline.session import scratch_path
from martline.sources import files
from martline.sources import testdata as td
from tests.helpers import rows, tmpdir, write


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_marts_read_the_fact_once(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.load(star.fact_sales(td.orders_source(spark, sf), with_sale_id=False), "fact_sales")
    tables = {"fact_sales": wh.read("fact_sales"), "dim_customers": star.dim_customers(td.customers_source(spark, sf)),
              "dim_products": star.dim_products(td.products_source(spark, sf))}
    assert plan_of(marts.fact_sums(tables["fact_sales"])).count("FileScan") == 1
    found = marts.all_marts(tables)
    assert all("/fact_sales/" not in plan_of(df) for df in found.values())
    for name, plain in (("sales_summary", marts.sales_summary(tables["fact_sales"])), ("daily_sales", marts.daily_sales(tables["fact_sales"])),
                        ("top_customers", marts.top_customers(tables["dim_customers"], tables["fact_sales"])),
                        ("category_performance", marts.category_performance(tables["dim_products"], tables["fact_sales"]))):
        assert found[name].columns == plain.columns and rows(found[name]) == rows(plain), name


def test_all_marts_of_an_empty_fact(spark):
    dc = spark.createDataFrame([(1, "a", "x", "X")], "customer_id BIGINT, customer_name STRING, city STRING, country STRING")
    dp = spark.createDataFrame([(10, "p", None, "b", Decimal("1.00"))], "product_id BIGINT, product_name STRING, category STRING, brand STRING, price DECIMAL(10,2)")
    f = spark.createDataFrame([], "customer_id BIGINT, product_id BIGINT, quantity INT, total_amount DECIMAL(10,2), discount DECIMAL(10,2), created_at TIMESTAMP_NTZ")
    found = marts.all_marts({"fact_sales": f, "dim_customers": dc, "dim_products": dp})
    assert rows(found["sales_summary"]) == [(0, 0, 0.0, 0.0, 0.0)] and rows(found["daily_sales"]) == []
    assert rows(found["top_customers"]) == [(1, "a", "x", "X", 0, None)]
    assert rows(found["stats"]) == [("dim_customers", 1, 2), ("dim_products", 1, 2), ("fact_sales", 0, 2)]


def test_dates_prune_the_fact_at_run_time(spark, sf):
    df = registry.QUERIES["bi_quarter_sales"](spark, sf)
    assert "dynamicpruning" in plan_of(df).replace(" ", "").lower()
    assert [r.month for r in df.orderBy("month").collect()] == [4, 5, 6, 7, 8, 9]


def test_bucketed_order_lines_join_without_a_shuffle(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for large tables
    try:
        df = registry._bucketed_sources(spark, sf)
        plan = plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert df.count() == td.orders_source(spark, sf).count()


def test_custom_aggregates_in_parts(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, *range(1, 50)])) for _ in range(400)] + [("c", 1, None), ("c", 1, None)]
    df = spark.createDataFrame(data, "k STRING, `l m` INT, v INT").repartition(7)
    spread = reg.CustomAggregate("spread", lambda s: (float(s.min()), float(s.max())), lambda a, b: (min(a[0], b[0]), max(a[1], b[1])), lambda t: t[1] - t[0])
    none = reg.CustomAggregate("n", lambda s: (len(s),), lambda a, b: (a[0] + b[0],), lambda t: 0 if t is None else t[0], empty=True)
    got = {tuple(r)[:2]: tuple(r)[2:] for r in aggregate_custom(df, ["k", "l m"], {"v": [reg.GEOMETRIC_MEAN, spread, none]}, dropna=False).collect()}
    plain = pd.DataFrame(data, columns=["k", "l", "v"])
    assert len(got) == len(plain.drop_duplicates(["k", "l"]))
    for (k, m), part in plain.groupby(["k", "l"], dropna=False):
        key, v = (None if pd.isna(k) else k, None if pd.isna(m) else int(m)), part["v"].dropna()
        if not len(v):
            assert got[key] == (None, None, 0.0)
            continue
        assert got[key] == pytest.approx((math.exp(sum(map(math.log, v)) / len(v)), v.max() - v.min(), len(v)))


def test_custom_aggregates_beside_built_in_ones(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", None), (None, 5.0)], "k STRING, v DOUBLE")

    def span(s):
        return s.max() - s.min() if len(s) else None

    out = aggregate_data(df, ["k"], {"v": ["sum", reg.GEOMETRIC_MEAN, "median", span]}, sort=True)
    assert out.columns == ["k", "v_sum", "v_gmean", "v_median", "v_span"]
    assert [tuple(r) for r in out.collect()] == [("a", 5.0, pytest.approx(2.0), 2.5, 3.0), ("b", 0.0, None, None, None)]
    assert rows(aggregate_data(df, [], {"v": ["count", reg.HARMONIC_MEAN]})) == [(3, pytest.approx(3 / (1 + 0.25 + 0.2)))]


def test_unnest_keeps_rows_without_elements(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None), (4, [None])], "id INT, `a.b` ARRAY<INT>")
    assert rows(unnest(df, "a.b", position="at"), "id", "at") == [(1, 5, 0), (1, 6, 1), (2, None, None), (3, None, None), (4, None, 0)]
    assert rows(unnest(df, "a.b", keep_empty=False), "id", "`a.b`") == [(1, 5), (1, 6), (4, None)]
    with pytest.raises(ValueError):
        unnest(df, "id")


def test_rejects_of_a_file_with_a_header(spark):
    base = tmpdir()
    path = write(base, "x.csv", 'id,name,price,day\n1,"a, b",2.5,2024-01-01\n2,b\nx,c,oops,2024-01-02\n3,d,NA,2024-01-03\n4,e,1.0,2024-01-04,more\n5,,,\n')
    scan = files.extract_csv_rejects(spark, path, "price DOUBLE, id INT, day DATE", scratch_path(spark, "scan"), null_value="NA")
    assert rows(scan.good, "id") == [(2.5, 1, dt.date(2024, 1, 1)), (None, 3, dt.date(2024, 1, 3)), (None, 5, None)]
    assert (scan.n_good, scan.n_rejects) == (3, 3)
    got = {r.line: (r.reason, r.fields) for r in scan.rejects.collect()}
    assert got == {"2,b": ("fields", None), "x,c,oops,2024-01-02": ("type", ["id", "price"]), "4,e,1.0,2024-01-04,more": ("fields", None)}
    assert all(r.file.endswith("x.csv") and r.block == 0 for r in scan.rejects.collect())
    report = files.scan_report(scan.good, path, expected_rows=6, rejected=scan.n_rejects).first()
    assert report.is_valid and report.warnings == ["3 rows, not 6", "3 lines rejected"]
    _, report = files.extract_csv_with_validation(spark, path, ["id", "phone"], rejects_to=scratch_path(spark, "scan"), schema="id INT, day DATE", null_value="NA")
    report = report.first()
    assert (report.rows_extracted, report.is_valid, report.errors, report.warnings) == (3, False, ["no column phone"], ["3 lines rejected"])
    clean = files.extract_csv_rejects(spark, write(base, "y.csv", "id,day\n1,2024-01-01\n"), "id INT, day DATE", scratch_path(spark, "scan"))
    assert clean.good.count() == 1 and clean.rejects.count() == 0
    with pytest.raises(FileNotFoundError):
        files.extract_csv_rejects(spark, f"{base}/none.csv", "id INT", scratch_path(spark, "scan"))
    with pytest.raises(ValueError):
        files.extract_csv_rejects(spark, path, "nowhere INT", scratch_path(spark, "scan"))


def test_names_with_dots_are_filled(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", 5), (3, "x", None), (4, "y", None)], "`a.t` INT, `a.k` STRING, `a.b` INT")
    out = fill_ordered(df, ["a.b"], ["a.t"], ["a.k"])
    assert out.columns == df.columns and rows(out, "`a.t`") == [(1, "x", None), (2, "x", 5), (3, "x", 5), (4, "y", None)]


def test_python_rules_say_what_they_raised(spark):
    df = spark.createDataFrame([(1, "5"), (2, "-1"), (3, "five"), (4, None)], "id INT, v STRING")

    def positive(v):
        return int(v) > 0

    out = quality.rule_violations(df, {"v": quality.python_rule("v", positive)}, ["id"], errors={"v": positive})
    got = {r.id: (r.value, r.error) for r in out.collect()}
    assert got[2] == ("-1", None) and got[3][1].startswith("ValueError: invalid literal") and got[4][1].startswith("TypeError") and 1 not in got


def test_outliers_by_group(spark):
    data = [("a", float(i % 7)) for i in range(70)] + [("a", 1000.0), ("b", 5.0), ("b", 5.0), ("b", 6.0), (None, 1e9), ("a", None)]
    out = quality.outliers(spark.createDataFrame(data, "k STRING, v DOUBLE"), "v", ["k"])
    assert sorted((r.k, r.v, r.median, r.deviation, r.robust_z is None) for r in out.collect()) == [("a", 1000.0, 3.0, 2.0, False), ("b", 6.0, 5.0, 0.0, True)]


def test_distinct_sketches_merge(spark):
    df = spark.range(30_000).selectExpr("id % 20000 AS v", "id % 3 AS load")
    parts = df.groupBy("load").agg(reg.distinct_sketch("v").alias("s"))
    assert parts.agg(reg.distinct_of("s").alias("n")).first().n == pytest.approx(20_000, rel=0.03)
    assert spark.createDataFrame([], "v INT").agg(reg.distinct_sketch("v").alias("s")).agg(reg.distinct_of("s").alias("n")).first().n == 0


def test_lineage_goes_both_ways(spark):
    wh = Warehouse(spark, tmpdir())
    one = spark.createDataFrame([(1,)], "i INT")
    wh.load(one, "raw", reads=["/in/a.csv", "/in/b.csv"])
    wh.load(one, "clean", reads=["raw"])
    wh.load(one, "clean", reads=["raw"])
    wh.load(one, "mart", reads=["clean", "dim", "mart"])  # a circle ends
    assert sorted(map(tuple, lineage.upstream(wh, "mart").collect())) == [("/in/a.csv", 3), ("/in/b.csv", 3), ("clean", 1), ("dim", 1), ("mart", 1), ("raw", 2)]
    assert sorted(map(tuple, lineage.downstream(Warehouse(spark, wh.root), "/in/a.csv").collect())) == [("clean", 2), ("mart", 3), ("raw", 1)]
    assert {(r.child, r.parent): r.loads for r in lineage.edges(wh).collect()}["clean", "raw"] == 2
    assert lineage.upstream(wh, "nothing").count() == 0


def test_header_after_other_lines(spark):
    base = tmpdir()
    text = "made by x\n\nid,name\n1,a\n2,b\n"
    for i in range(2):
        write(base, f"{i}.csv", text)
    for schema in ("id INT, name STRING", None):
        df = files.extract_csv(spark, base, schema=schema, header=2)
        assert rows(df, "id") == [(1, "a"), (1, "a"), (2, "b"), (2, "b")] and "Python" not in plan_of(df)


def test_buckets_grow_with_the_order_lines():
    assert registry._buckets(1000) == 8
    assert registry._buckets(8 * registry.BUCKET_ROWS + 1) == 9
