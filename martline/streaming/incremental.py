"""Streaming incremental loads (the reference's "streaming" run mode).

A file source replaces "SELECT MAX(ts)": the stream's offset log in the checkpoint records what was read, so
a rerun reads only new files. Every micro-batch is reduced and appended to the warehouse as a load that carries the
batch's number (``foreachBatch``): a replayed batch is not loaded twice, and a load costs what the batch
holds, not what the table holds. Nothing waits for a watermark and nothing is dropped as late; how
files are dealt to batches can't change a result. ``trigger(availableNow=True)`` processes what is there and stops
(a scheduled incremental job); without it the job is continuous.

* ``daily_sales_stream``    a day's sums of each batch; ``daily_sales`` adds them up.
* ``latest_per_key_stream`` a batch's newest row per key; ``latest_rows`` takes the newest of them.
* ``append_stream``         the batch's rows; small loads are merged, so their number stays small.
* ``dedup_stream``          first of the rows of a key within a time span, by Spark's state; what comes too late for the state is kept
                            aside. ``dedup_rows`` reads both.
* ``window_sums_stream``    sums by sliding (or tumbling) windows; ``window_sums`` adds the batches' parts up.
* ``sessions_stream``       sessions of a key with a gap, merged in Spark's state, given out when they are closed.

Batches are cut by files or bytes (``max_files_per_trigger``, ``max_bytes_per_trigger``). The loads of a summed table are replaced
by one with the added up (newest) rows when, from ``compact_every`` loads on, those behind the first hold as many rows as it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.plans.warehouse import Warehouse


def _source(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None, max_bytes: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(path)


def _run(events: DataFrame, checkpoint: str, available_now: bool, batch):  # noqa: ANN001, ANN202
    w = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def _append(warehouse: Warehouse, df: DataFrame, table: str, batch_id: str, readable, compact_every: int) -> None:  # noqa: ANN001
    warehouse.load(df, table, "append", batch_id=batch_id)
    if warehouse.exists(table) and warehouse.loads(table) >= compact_every:
        first, *rest = [r.rows for r in warehouse._chain(table)]
        if sum(rest) >= first:
            warehouse.compact(readable(), table)


def daily_sales_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse,
                       table: str, checkpoint: str, date_column: str = "created_at",
                       max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None, available_now: bool = True, compact_every: int = 32):
    """Tumbling one-day windows: order lines, quantity and revenue. Read them with ``daily_sales``."""
    kind = schema[date_column].dataType

    def batch(rows: DataFrame, number: int) -> None:
        start = F.date_trunc("day", F.col(date_column)).cast(kind)
        parts = (rows.where(F.col(date_column).isNotNull()).groupBy(start.alias("window_start"))
                 .agg(F.count(F.lit(1)).alias("order_count"), F.sum("quantity").alias("total_quantity"), F.sum("total_amount").alias("total_revenue")))
        _append(warehouse, parts, table, f"{checkpoint}#{number}",
                lambda: daily_sales(warehouse, table).drop("window_end"), compact_every)

    return _run(_source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger), checkpoint, available_now, batch)


def daily_sales(warehouse: Warehouse, table: str) -> DataFrame:
    """window_start, window_end, order_count, total_quantity, total_revenue of all batches so far."""
    parts = warehouse.read(table)
    same = lambda c: F.sum(c).cast(parts.schema[c].dataType).alias(c)
    out = parts.groupBy("window_start").agg(same("order_count"), same("total_quantity"), same("total_revenue"))
    end = (F.col("window_start") + F.expr("INTERVAL 1 DAY")).cast(parts.schema["window_start"].dataType)
    return out.select("window_start", end.alias("window_end"), "order_count", "total_quantity", "total_revenue")


def latest_per_key_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse,
                          table: str, checkpoint: str, key: Sequence[str], columns: Sequence[str], newer_by: Sequence[str],
                          max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None, available_now: bool = True, compact_every: int = 32):
    """Keep, per ``key``, the row with the greatest ``newer_by`` (stored columns). Read it with ``latest_rows``. Events that
    are late or sent again change nothing."""

    def batch(rows: DataFrame, number: int) -> None:
        _append(warehouse, _newest(rows.select(*columns), key, newer_by), table, f"{checkpoint}#{number}",
                lambda: latest_rows(warehouse, table, key, newer_by), compact_every)

    return _run(_source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger), checkpoint, available_now, batch)


def _newest(df: DataFrame, key: Sequence[str], newer_by: Sequence[str]) -> DataFrame:
    names = df.columns
    rest = [c for c in names if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*newer_by)).alias("__row")).select(*key, "__row.*").select(*names)


def latest_rows(warehouse: Warehouse, table: str, key: Sequence[str], newer_by: Sequence[str]) -> DataFrame:
    return _newest(warehouse.read(table), key, newer_by)


def append_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse,
                  table: str, checkpoint: str, watermark_column: str | None = None,
                  max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None, available_now: bool = True, merge_every: int = 16):
    """K5/K8 as a stream: each micro-batch is one load, named after its number; small loads are merged from ``merge_every`` on."""

    def batch(rows: DataFrame, number: int) -> None:
        warehouse.load(rows, table, "append", watermark_column=watermark_column, batch_id=f"{checkpoint}#{number}")
        warehouse.merge_small(table, merge_every)

    return _run(_source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger), checkpoint, available_now, batch)


TIME = "__time"


def dedup_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse, table: str, late_table: str,
                 checkpoint: str, key: Sequence[str], time_column: str, delay: str = "1 hour", max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None, merge_every: int = 16) -> None:
    """Rows of new keys go to ``table``: one of all rows of a key whose times are less than ``delay`` apart
    (``dropDuplicatesWithinWatermark``; Spark forgets a key when the watermark, ``delay`` behind the newest time, has passed it). Rows
    that come after the watermark has passed them never reach that state. A second stream over the same files finds them: those of keys
    that ``table`` lacks go to ``late_table``, one a key. So no key is lost, in whatever order files come, also after a
    restart; each stream has its own checkpoint. Processes what is there and stops.

    Rows with a null time or key column count as late (they can't be in the state)."""
    names = schema.names
    source = lambda: _source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger)
    present = F.col(time_column).isNotNull()
    for k in key:
        present = present & F.col(k).isNotNull()
    kept = (source().where(present).withColumn(TIME, F.col(time_column).cast("timestamp")).withWatermark(TIME, delay)
            .dropDuplicatesWithinWatermark(list(key)).select(*names))

    def first(rows: DataFrame, number: int) -> None:
        warehouse.load(rows, table, "append", batch_id=f"{checkpoint}/kept#{number}")
        if warehouse.exists(table):
            warehouse.merge_small(table, merge_every)

    def late(rows: DataFrame, number: int) -> None:
        for t in (table, late_table):
            if warehouse.exists(t):
                known = warehouse.read(t).select(*[F.col(k).alias(f"__{k}") for k in key])
                same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
                rows = rows.join(known, same, "left_anti")
        warehouse.load(rows.dropDuplicates(list(key)), late_table, "append", batch_id=f"{checkpoint}/late#{number}")
        if warehouse.exists(late_table):
            warehouse.merge_small(late_table, merge_every)

    _run(kept, f"{checkpoint}/kept", True, first)
    _run(source(), f"{checkpoint}/late", True, late)


def dedup_rows(warehouse: Warehouse, table: str, late_table: str) -> DataFrame:
    """One row of every key that came, in time or late."""
    found = [warehouse.read(t) for t in (table, late_table) if warehouse.exists(t)]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def sessions_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse, table: str, checkpoint: str,
                    key: str, time_column: str, value_column: str, gap: str = "30 minutes", delay: str = "10 minutes",
                    heartbeat: str | None = None, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                    merge_every: int = 16) -> None:
    """Sessions of ``key``: rows less than ``gap`` apart, merged in Spark's state store whatever batches they come in, and appended to
    ``table`` when the watermark, ``delay`` behind the newest time, has passed their end: (key, session_start, session_end, n_rows,
    total). Rows older than the watermark are too late for sessions that are already out; choose ``delay`` by how late rows may be.

    Open sessions wait for newer rows. Where ``heartbeat`` names a boolean column, its true rows only move time on."""
    source = _source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger)
    beats = F.col(heartbeat) if heartbeat else F.lit(False)
    kind = schema[time_column].dataType
    out = (source.where(F.col(time_column).isNotNull())
           .select(F.col(key), F.col(time_column).cast("timestamp").alias(TIME), F.col(value_column).alias("__value"), beats.alias("__beat"))
           .withWatermark(TIME, delay).groupBy(F.session_window(TIME, gap).alias("s"), F.col(key), F.col("__beat"))
           .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__value").alias("total")))

    def batch(rows: DataFrame, number: int) -> None:
        closed = rows.where(~F.col("__beat")).select(key, F.col("s.start").cast(kind).alias("session_start"), F.col("s.end").cast(kind).alias("session_end"), "n_rows", "total")
        warehouse.load(closed, table, "append", batch_id=f"{checkpoint}#{number}")
        if warehouse.exists(table):
            warehouse.merge_small(table, merge_every)

    w = out.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint)
    w.trigger(availableNow=True).start().awaitTermination()


def window_sums_stream(spark: SparkSession, source_path: str, schema: T.StructType, warehouse: Warehouse, table: str, checkpoint: str,
                       time_column: str, sums: Sequence[str], width: str, slide: str | None = None, key: Sequence[str] = (),
                       max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None, available_now: bool = True,
                       compact_every: int = 32):  # noqa: ANN201
    """Tumbling (``slide`` None) or sliding windows of ``width``: rows and sums by window and key. Each batch appends its own part of
    every window it touches, so nothing is too late. Read them with ``window_sums``."""
    kind = schema[time_column].dataType

    def batch(rows: DataFrame, number: int) -> None:
        at = F.window(F.col(time_column).cast("timestamp"), width, slide)
        parts = (rows.where(F.col(time_column).isNotNull()).groupBy(at.alias("w"), *key)
                 .agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in sums])
                 .select(F.col("w.start").cast(kind).alias("window_start"), F.col("w.end").cast(kind).alias("window_end"), *key, "n_rows", *sums))
        _append(warehouse, parts, table, f"{checkpoint}#{number}", lambda: window_sums(warehouse, table, key), compact_every)

    return _run(_source(spark, source_path, schema, max_files_per_trigger, max_bytes_per_trigger), checkpoint, available_now, batch)


def window_sums(warehouse: Warehouse, table: str, key: Sequence[str] = ()) -> DataFrame:
    """window_start, window_end, keys, n_rows and sums of all batches so far."""
    parts = warehouse.read(table)
    by = ["window_start", "window_end", *key]
    return parts.groupBy(*by).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in parts.columns if c not in by])
