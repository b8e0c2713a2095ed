import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martline.plans import registry, warehouse
from martline.plans.warehouse import Warehouse, _load_id, create_table_sql, incremental_rows, merge_upsert
from tests.helpers import rows, tmpdir

SCHEMA = "id INT, name STRING, price DOUBLE"


def test_merge_upsert_cases(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    batch = spark.createDataFrame([(2, "B", 20.0, 1), (2, "B2", 21.0, 2), (3, "c", 3.0, 1)],
                                  "id INT, name STRING, price DOUBLE, seq INT")
    full = rows(merge_upsert(target, batch, ["id"], order_by=["seq"]), "id")
    assert full == [(1, "a", 1.0), (2, "B2", 21.0), (3, "c", 3.0)]   # last duplicate wins
    part = rows(merge_upsert(target, batch, ["id"], ["price"], order_by=["seq"]), "id")
    assert part == [(1, "a", 1.0), (2, "b", 21.0), (3, "c", 3.0)]    # unlisted columns kept
    keys_only = rows(merge_upsert(target, spark.createDataFrame([(2,), (4,)], "id INT"), ["id"]), "id")
    assert keys_only == [(1, "a", 1.0), (2, "b", 2.0), (4, None, None)]  # insert-if-absent
    subset = rows(merge_upsert(target, spark.createDataFrame([(1, 9.0)], "id INT, price DOUBLE"), ["id"]), "id")
    assert subset[0] == (1, "a", 9.0)
    newer = spark.createDataFrame([(1, "old", 0.5)], SCHEMA)
    guarded = rows(merge_upsert(target, newer, ["id"], only_if_newer=["price"]), "id")
    assert guarded[0] == (1, "a", 1.0)
    with pytest.raises(ValueError):
        merge_upsert(target, spark.createDataFrame([(1, 1)], "id INT, extra INT"), ["id"])


def test_warehouse_modes_upsert_idempotent(spark):
    wh = Warehouse(spark, tmpdir())
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    assert wh.load(df.limit(0), "t")["status"] == "skipped"
    assert wh.load(df, "t", "fail")["rows_loaded"] == 2
    with pytest.raises(ValueError):
        wh.load(df, "t", "fail")
    wh.load(df, "t", "append")
    assert wh.read("t").count() == 4
    wh.load(df, "t", "replace")
    assert wh.read("t").count() == 2
    batch = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0)], SCHEMA)
    wh.upsert(batch, "t", ["id"])
    first = rows(wh.read("t"), "id")
    wh.upsert(batch, "t", ["id"])
    assert rows(wh.read("t"), "id") == first == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0)]
    assert wh.upsert(batch.limit(0), "t", ["id"])["status"] == "skipped"
    assert wh.audit().where("table_name = 't'").count() == 5  # create, append, replace, 2 upserts
    wh.drop_star_schema()
    made = wh.create_star_schema()
    assert sorted(made) == ["dim_customers", "dim_date", "dim_products", "fact_sales"]
    assert wh.read("fact_sales").count() == 0


def test_incremental_rules(spark):
    wm = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, wm), (3, dt.datetime(2024, 1, 3)), (4, None)],
                               "id INT, created_at TIMESTAMP_NTZ")
    assert [r.id for r in incremental_rows(df, "created_at", wm).collect()] == [3]
    assert incremental_rows(df, "created_at", None).count() == 4
    assert incremental_rows(df, "missing", wm).count() == 4
    wh = Warehouse(spark, tmpdir())
    assert wh.watermark("none", "created_at") is None
    assert wh.incremental_load(df.where("id < 3"), "f")["rows_loaded"] == 2     # no target: all
    assert wh.watermark("f", "created_at") == wm
    assert wh.incremental_load(df, "f")["rows_loaded"] == 1                      # only id 3
    assert wh.incremental_load(df, "f")["status"] == "no_new_data"               # twice: nothing new
    assert sorted(r.id for r in wh.read("f").collect()) == [1, 2, 3]
    assert F is not None


def test_drop_and_recreate_uses_new_version(spark):
    root = tmpdir()
    wh = Warehouse(spark, root)
    wh.create_star_schema()
    wh.load(spark.createDataFrame([(1, "a")], "customer_id BIGINT, customer_name STRING"), "dim_customers",
            "replace")
    wh.drop_star_schema()
    assert wh.tables() == []
    wh2 = Warehouse(spark, root)                 # a fresh reader sees the drop in the audit
    assert not wh2.exists("dim_customers")
    wh2.create_star_schema()
    assert wh2.version("dim_customers") == 2 and wh2.read("dim_customers").count() == 0


def test_bucketed_upsert_shuffles_the_batch_only(spark):
    wh = Warehouse(spark, tmpdir())
    base = spark.range(0, 200).selectExpr("id", "concat('n', id) AS name", "CAST(id AS DOUBLE) AS price")
    wh.create_bucketed(base, "dim", ["id"], 16)
    batch = spark.createDataFrame([(5, "five", 50.0), (5, "FIVE", 55.0), (500, "new", 1.0)],
                                  "id BIGINT, name STRING, price DOUBLE")
    plan = merge_upsert(wh.read("dim"), batch.repartition(16, "id"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    assert wh.upsert(batch, "dim", ["id"])["rows_upserted"] == 201
    out = {r.id: (r.name, r.price) for r in wh.read("dim").collect()}
    assert len(out) == 201 and out[500] == ("new", 1.0) and out[7] == ("n7", 7.0)
    assert out[5] in {("five", 50.0), ("FIVE", 55.0)}
    wh.upsert(batch, "dim", ["id"])
    assert wh.read("dim").count() == 201          # idempotent
    wh.load(spark.createDataFrame([(900, "app", 1.0)], "id BIGINT, name STRING, price DOUBLE"), "dim", "append")
    assert wh.read("dim").count() == 202
    wh.upsert(spark.createDataFrame([(900, "app2", 2.0)], "id BIGINT, name STRING, price DOUBLE"), "dim", ["id"])
    out = {r.id: r.name for r in Warehouse(spark, wh.root).read("dim").collect()}
    assert len(out) == 202 and out[900] == "app2" and out[500] == "new"
    wh.load(base.limit(3), "dim", "replace")
    assert wh.read("dim").count() == 3 and wh._layout("dim") == (["id"], 16)
    assert wh.read("dim").groupBy("id").count().count() == 3
    wh._record("dim", wh.version("dim"), "drop", 0)
    wh.create_bucketed(base, "dim", ["id"], 4)    # a dropped table can be made again
    assert wh.read("dim").count() == 200 and not [t for t in spark.catalog.listTables() if t.name.startswith("martline")]


def test_batches_of_dropped_and_replaced_tables_load_again(spark):
    """After a drop or a replace the table does not hold the batch any more; a merge, an upsert and a compaction keep it."""
    root = tmpdir()
    wh = Warehouse(spark, root)
    df = spark.range(10).selectExpr("id AS sale_id", "CAST(id AS INT) AS quantity", "CAST(1.5 AS DECIMAL(10,2)) AS unit_price", "CAST(2 AS DECIMAL(10,2)) AS total_amount")
    for make in (Warehouse(spark, root).create_star_schema, lambda: None):
        make()
        wh.refresh()
        assert wh.load_fact_table(df, "fact_sales", batch_id="b")["rows_loaded"] == 10
        assert Warehouse(spark, root).load_fact_table(df, "fact_sales", batch_id="b")["status"] == "duplicate_batch"
        assert wh.read("fact_sales").count() == 10
        wh.drop_star_schema()
    assert wh.load_fact_table(df, "fact_sales", batch_id="b")["rows_loaded"] == 10
    wh.load(df.limit(1), "fact_sales", "replace", batch_id="r")
    assert wh.load_fact_table(df, "fact_sales", batch_id="b")["rows_loaded"] == 10 and wh.read("fact_sales").count() == 11
    wh.compact(wh.read("fact_sales"), "fact_sales")
    wh.upsert(df.limit(2), "fact_sales", ["sale_id"])
    for b in ("b", "r"):
        assert Warehouse(spark, root).load_fact_table(df, "fact_sales", batch_id=b)["status"] == "duplicate_batch"


def test_loads_that_do_not_fit_are_refused(spark):
    wh = Warehouse(spark, tmpdir())
    wh.load(spark.createDataFrame([(1, 1.0)], "i BIGINT, x DOUBLE"), "t")
    for other, said in (("i BIGINT, x STRING", "x is double, not string"), ("i BIGINT, y DOUBLE", "no column y"), ("i DOUBLE, x DOUBLE", "i is bigint")):
        with pytest.raises(ValueError, match=said):
            wh.load(spark.createDataFrame([], other), "t", "append")
    wh.load(spark.createDataFrame([(2,)], "i INT"), "t", "append")  # narrower, and without x
    assert rows(Warehouse(spark, wh.root).read("t"), "i") == [(1, 1.0), (2, None)]
    wh.load(spark.createDataFrame([("a",)], "s STRING"), "t", "replace")  # a replace may change the columns
    assert wh.read("t").columns == ["s"] and wh.loads("t") == 1


def test_partitioned_facts_in_any_order_of_calls(spark):
    df = spark.createDataFrame([(1, 20240101, 2), (2, 20240102, 3)], "sale_id BIGINT, date_id INT, quantity INT")
    for partition in (["date_id"], None):
        wh = Warehouse(spark, tmpdir())
        wh.create_star_schema()
        wh.load_fact_table(df, "fact_sales", partition_by=partition)
        wh.load_fact_table(df, "fact_sales")                       # keeps the layout
        wh.load_fact_table(df, "fact_sales", partition_by=partition)
        if not partition:
            with pytest.raises(ValueError, match="partitioned by"):
                wh.load_fact_table(df, "fact_sales", partition_by=["date_id"])
        got = Warehouse(spark, wh.root).read("fact_sales")
        assert got.columns == [c.split()[0] for c in warehouse.STAR_DDL["fact_sales"].replace("10,2", "10").split(", ")]
        assert got.where("date_id = 20240102").count() == 3 and got.count() == 6 and dict(got.dtypes)["date_id"] == "int"
        wh.upsert(spark.createDataFrame([(1, 20240105, 9)], df.schema), "fact_sales", ["sale_id"])
        assert wh.read("fact_sales").where("quantity = 9 and date_id = 20240105").count() == 3


def test_small_loads_are_merged(spark):
    wh = Warehouse(spark, tmpdir())
    for i in range(20):
        wh.load(spark.range(i * 10, i * 10 + 10).selectExpr("id", "CAST(id AS STRING) AS w"), "t", "append", watermark_column="id", batch_id=f"b{i}", high=["id"])
        wh.merge_small("t", 4)
        assert wh.loads("t") < 9
    again = Warehouse(spark, wh.root)
    assert again.loads("t") == wh.loads("t") and sorted(r.id for r in again.read("t").collect()) == list(range(200))
    assert again.has_batch("t", "b0") and again.watermark("t", "id") == 199 == again.largest("t", "id")
    assert again.largest("t", "w") == "99"


def test_recorded_watermark_and_replayed_batches(spark):
    wh = Warehouse(spark, tmpdir())
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))],
                               "id INT, created_at TIMESTAMP_NTZ")
    wh.load(df, "f", "append", watermark_column="created_at", batch_id="s#0")
    assert wh.load(df, "f", "append", watermark_column="created_at", batch_id="s#0")["status"] == "duplicate_batch"
    more = spark.createDataFrame([(3, dt.datetime(2024, 1, 9))], df.schema)
    wh._write(more, "f", wh.version("f"), _load_id("s#1"))          # lost between files and audit row
    assert wh.read("f").count() == 2 and Warehouse(spark, wh.root).read("f").count() == 2
    wh.load(more, "f", "append", watermark_column="created_at", batch_id="s#1")
    assert all(r.watermark_column == "created_at" for r in wh._chain("f"))          # answered from the audit
    assert wh.watermark("f", "created_at") == wh.read("f").agg(F.max("created_at")).first()[0] == dt.datetime(2024, 1, 9)
    assert wh.read("f").count() == 3
    wh.load(more, "f", "append")                                  # an unrecorded load -> scan
    assert wh.watermark("f", "created_at") == dt.datetime(2024, 1, 9)
    with pytest.raises(ValueError):
        wh.watermark("f", "no_such_column")


@pytest.mark.parametrize("kind,values,top", [("DECIMAL(10,2)", ["9.00", "10.00", "-3.50"], "10.00"), ("STRING", ["b", "a10", "a9"], "b"),
                                             ("BIGINT", ["9", "10", None], "10"), ("DATE", ["2024-01-09", "2023-12-31", None], "2024-01-09")])
def test_watermark_keeps_its_type(spark, kind, values, top):
    wh = Warehouse(spark, tmpdir())
    for i, v in enumerate(values):
        wh.load(spark.createDataFrame([(v,)], "s STRING").select(F.col("s").cast(kind).alias("w")), "t", "append", watermark_column="w", batch_id=str(i))
    got = wh.watermark("t", "w")
    assert str(got) == top and got == wh.read("t").agg(F.max("w")).first()[0]


def test_audit_is_collected_and_reading_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "COMPACT", 4)
    root = tmpdir()
    assert Warehouse(spark, root).tables() == [] and not os.path.exists(f"{root}/_audit")
    wh = Warehouse(spark, root)
    for i in range(10):
        wh.load(spark.createDataFrame([(i,)], "i INT"), "t", "append", batch_id=f"b{i}")
    again = Warehouse(spark, root)
    assert sorted(r.i for r in again.read("t").collect()) == list(range(10)) and again.audit().count() == 10
    assert again._audit_base()[0] == 8 and again.has_batch("t", "b3")
    again.compact(again.read("t"), "t")
    assert again.loads("t") == 1 and again.has_batch("t", "b3") and Warehouse(spark, root).read("t").count() == 10


def test_star_tables_take_the_load_time(spark):
    wh = Warehouse(spark, tmpdir())
    wh.create_star_schema()
    rows_ = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id BIGINT, customer_name STRING")
    wh.load_dimension_table(rows_, "dim_customers", "customer_id")
    first = {r.customer_id: r.created_at for r in wh.read("dim_customers").collect()}
    assert len(first) == 2 and None not in first.values()
    wh.load_dimension_table(rows_.union(spark.createDataFrame([(3, "c")], rows_.schema)), "dim_customers", "customer_id")
    then = {r.customer_id: r.created_at for r in wh.read("dim_customers").collect()}
    assert then[1] == first[1] and then[3] is not None
    wh.load(spark.createDataFrame([(9, "n")], "product_id BIGINT, product_name STRING"), "dim_products", "append")
    assert wh.read("dim_products").first().created_at is not None
    sql = create_table_sql("fact_sales", "/x") + create_table_sql("dim_date", "/x")
    assert "created_at TIMESTAMP_NTZ DEFAULT LOCALTIMESTAMP" in sql and "created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP" in sql


def test_created_table_fills_the_default(spark):
    name = "martline_default_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(create_table_sql("dim_products", tmpdir()).replace("dim_products", name))
    spark.sql(f"INSERT INTO {name} (product_id, product_name) VALUES (1, 'x')")
    assert spark.table(name).first().created_at is not None
    spark.sql(f"DROP TABLE {name}")


def test_loads_of_one_fact_derive_it_once(spark, sf, monkeypatch):
    """What several loads read is joined once; the loads read its files."""
    landed = []
    keep = registry._landed

    def record(spark, df, name):
        landed.append((name, keep(spark, df, name)))
        return landed[-1][1]

    monkeypatch.setattr(registry, "_landed", record)
    for q in ("load_after_drop", "bi_distinct_incremental"):
        registry.QUERIES[q](spark, sf).limit(1).collect()
    assert [n for n, _ in landed] == ["fact", "categories"]
    assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for _, df in landed)
    assert all(df.count() == registry.fact(spark, sf).count() for _, df in landed)


def test_a_jobs_files_are_compressed(spark, sf, tmp_path):
    from pathlib import Path

    paths = registry.land_sources(spark, sf, str(tmp_path))
    assert all(f.name.endswith(".gz") for p in paths.values() for f in Path(p).glob("part-*"))
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    wh.load(spark.range(10), "t")
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "warehouse" / "t").rglob("part-*"))
