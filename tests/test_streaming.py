import datetime as dt

from pyspark.sql import functions as F

from martline.plans.warehouse import Warehouse
from martline.streaming.incremental import (append_stream, daily_sales, daily_sales_stream, dedup_rows, dedup_stream, latest_per_key_stream,
                                             latest_rows, sessions_stream, window_sums, window_sums_stream)
from tests.helpers import rows, tmpdir

FACT = "created_at TIMESTAMP_NTZ, quantity INT, total_amount DECIMAL(10,2)"


def test_daily_stream_updates_windows_and_resumes(spark):
    base = tmpdir()
    d1 = [(dt.datetime(2024, 1, 1, 10), 1, 10), (dt.datetime(2024, 1, 1, 11), 2, 20), (dt.datetime(2024, 1, 2, 9), 3, 30)]
    df1 = spark.createDataFrame(d1, "created_at TIMESTAMP_NTZ, quantity INT, total_amount INT") \
               .withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    df1.write.parquet(f"{base}/in/batch1")
    wh = Warehouse(spark, f"{base}/wh")
    src = f"{base}/in/*"
    daily_sales_stream(spark, src, df1.schema, wh, "daily", f"{base}/ckpt")
    got = rows(daily_sales(wh, "daily").select("window_start", "order_count", "total_quantity"), "window_start")
    assert got == [(dt.datetime(2024, 1, 1), 2, 3), (dt.datetime(2024, 1, 2), 1, 3)]
    daily_sales_stream(spark, src, df1.schema, wh, "daily", f"{base}/ckpt")   # nothing new: unchanged
    assert rows(daily_sales(wh, "daily").select("window_start", "order_count", "total_quantity"), "window_start") == got
    df2 = spark.createDataFrame([(dt.datetime(2024, 1, 2, 20), 4, 40)], "created_at TIMESTAMP_NTZ, quantity INT, total_amount INT") \
               .withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    df2.write.parquet(f"{base}/in/batch2")
    daily_sales_stream(spark, src, df1.schema, wh, "daily", f"{base}/ckpt")
    got2 = rows(daily_sales(wh, "daily").select("window_start", "order_count", "total_quantity"), "window_start")
    assert got2 == [(dt.datetime(2024, 1, 1), 2, 3), (dt.datetime(2024, 1, 2), 2, 7)]


def test_latest_per_key_ignores_late_and_redelivered(spark):
    base = tmpdir()
    schema = "order_id BIGINT, customer_id BIGINT, order_date TIMESTAMP_NTZ"
    spark.createDataFrame([(1, 7, dt.datetime(2024, 1, 5)), (2, 8, dt.datetime(2024, 1, 1))], schema) \
         .write.parquet(f"{base}/in/a")
    wh = Warehouse(spark, f"{base}/wh")
    kw = dict(key=["customer_id"],
              columns=["customer_id", F.col("order_date").alias("last_date"), F.col("order_id").alias("last_id")],
              newer_by=["last_date", "last_id"])
    df = spark.read.schema(schema).parquet(f"{base}/in/a")
    latest_per_key_stream(spark, f"{base}/in/*", df.schema, wh, "act", f"{base}/ckpt", **kw)
    # a late file: an older order of customer 7 and a redelivered order 2
    spark.createDataFrame([(3, 7, dt.datetime(2023, 12, 1)), (2, 8, dt.datetime(2024, 1, 1))], schema) \
         .write.parquet(f"{base}/in/b")
    latest_per_key_stream(spark, f"{base}/in/*", df.schema, wh, "act", f"{base}/ckpt", **kw)
    assert rows(latest_rows(wh, "act", ["customer_id"], kw["newer_by"]), "customer_id") == [(7, dt.datetime(2024, 1, 5), 1), (8, dt.datetime(2024, 1, 1), 2)]


def test_batching_and_file_order_change_nothing(spark):
    """Files newest first and oldest first, one a batch, with and without compaction: no row is dropped."""
    days = [(dt.datetime(2024, 1, 1 + i // 4, i % 24), i, i * 10) for i in range(40)]
    want = None
    for name, order in (("up", days), ("down", days[::-1])):
        base = tmpdir()
        for i in range(4):
            df = spark.createDataFrame(order[i * 10 : i * 10 + 10], "created_at TIMESTAMP_NTZ, quantity INT, total_amount INT") \
                .withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
            df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        for compact in (2, 99):
            wh = Warehouse(spark, f"{base}/wh{compact}")
            daily_sales_stream(spark, f"{base}/in", df.schema, wh, "daily", f"{base}/c{compact}", max_files_per_trigger=1, compact_every=compact)
            got = rows(daily_sales(wh, "daily"), "window_start")
            want = want or got
            assert got == want and sum(r[2] for r in got) == 40, (name, compact)
            assert wh.loads("daily") <= max(compact, 4)


def test_append_stream_replays_a_lost_batch(spark):
    base = tmpdir()
    df = spark.range(0, 20).withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    df.limit(10).coalesce(1).write.parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/wh")
    append_stream(spark, f"{base}/in", df.schema, wh, "f", f"{base}/c", "created_at")
    append_stream(spark, f"{base}/in", df.schema, wh, "f", f"{base}/c", "created_at")
    assert wh.read("f").count() == 10
    wh.load(df.limit(10), "f", "append", batch_id=f"{base}/c#0")     # the batch comes again
    assert wh.read("f").count() == 10


EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value BIGINT"


def _land(spark, base, number, data):
    spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(f"{base}/in/{number}")


def test_dedup_stream_loses_no_event_in_any_order_of_files(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [[(1, day(1), 1, 1), (2, day(1, 5), 1, 2), (1, day(1), 1, 1)], [(3, day(9), 2, 3), (2, day(1, 5), 1, 2)], [(4, day(2), 2, 4), (3, day(9), 2, 3), (None, day(3), 2, 9)],
             [(5, day(20), 3, 5), (1, day(1), 1, 1), (6, None, 3, 6)]]
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2)):
        base = tmpdir()
        wh = Warehouse(spark, f"{base}/wh")
        schema = spark.createDataFrame([], EVENTS).schema
        for n, i in enumerate(order):  # every file is a run of its own: a restart in between
            _land(spark, base, n, parts[i])
            dedup_stream(spark, f"{base}/in/*", schema, wh, "kept", "late", f"{base}/ckpt", ["event_id"], "ts", delay="1 day", max_files_per_trigger=1)
        got = dedup_rows(Warehouse(spark, wh.root), "kept", "late")
        assert sorted(str(r.event_id) for r in got.collect()) == ["1", "2", "3", "4", "5", "6", "None"]
        kept, late = ({r.event_id for r in wh.read(t).collect()} for t in ("kept", "late"))
        assert not kept & late and {None, 6} <= late and (order[0] or 4 in late)


def test_sessions_over_batches_are_those_of_one_batch(spark):
    base, schema = tmpdir(), spark.createDataFrame([], EVENTS + ", beat BOOLEAN").schema
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    files = [[(1, at(0), 1, 1), (2, at(20), 1, 2), (3, at(5), 2, 3)], [(4, at(45), 1, 4), (5, at(76), 1, 5), (6, at(10), 2, 6)], [(7, at(75), 1, 7), (8, at(40), None, 8)],
             [(None, at(5000), None, 0)]]
    wh = Warehouse(spark, f"{base}/wh")
    for n, data in enumerate(files):
        spark.createDataFrame([(*r, n == 3) for r in data], schema).coalesce(1).write.parquet(f"{base}/in/{n}")
        sessions_stream(spark, f"{base}/in/*", schema, wh, "sessions", f"{base}/ckpt", "user_id", "ts", "value", gap="30 minutes", delay="2 hours", heartbeat="beat")
    got = sorted((str(r.user_id), r.session_start, r.session_end, r.n_rows, r.total) for r in wh.read("sessions").collect())
    assert got == [("1", at(0), at(106), 5, 19), ("2", at(5), at(40), 2, 9), ("None", at(40), at(70), 1, 8)]


def test_sliding_windows_add_up_over_late_batches(spark):
    base, schema = tmpdir(), spark.createDataFrame([], EVENTS).schema
    for n, data in enumerate([[(1, dt.datetime(2024, 1, 5, 3), 1, 10)], [(2, dt.datetime(2024, 1, 4, 22), 1, 5), (3, None, 1, 9)], [(4, dt.datetime(2024, 1, 5, 1), 2, 7)]]):
        _land(spark, base, n, data)
    wh = Warehouse(spark, f"{base}/wh")
    window_sums_stream(spark, f"{base}/in/*", schema, wh, "w", f"{base}/ckpt", "ts", ["value"], "2 days", "1 day", max_files_per_trigger=1, compact_every=2)
    day = lambda d: dt.datetime(2024, 1, d)
    assert rows(window_sums(wh, "w"), "window_start") == [(day(3), day(5), 1, 5), (day(4), day(6), 3, 22), (day(5), day(7), 2, 17)]


def test_landed_files_grow_with_the_table_not_in_number(spark):
    from martline.plans import registry

    assert registry._file_rows(spark.range(1000), 500) == 500
    assert registry._file_rows(spark.range(registry.LANDED_FILES * 1000), 500) == 1000
    assert registry._file_rows(spark.range(registry.LANDED_FILES * 1000 + 1), 500) == 1001
