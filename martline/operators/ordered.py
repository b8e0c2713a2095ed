"""Order-dependent operators that stay distributed under key skew.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task,
and an unpartitioned window puts the whole table into one task. The helpers
here instead range-partition on the *full* sort key (keys + order columns), so
a hot key is split over many partitions, do the work per partition, and stitch
partition boundaries together with a summary that has one row per partition
(bounded by the partition count, which is what gets broadcast).

The partition-tagged data is read twice (for the per-partition summary and
for the final rows). Range bounds come from sampling, which depends on input
row order, so two evaluations could disagree; the tagged data is therefore
materialized once with a reliable ``checkpoint()`` into the shared
``spark.checkpoint.dir`` (never a local checkpoint), which also cuts lineage.

* ``global_row_number``  dense 1..n numbering in a total order (surrogate keys,
  exact quantiles) - the DataFrame form of a zip-with-index.
* ``fill_ordered``       forward / backward fill of NULLs in a per-key order
  (or globally), W1/W2.
* ``exact_medians`` / ``grouped_exact_median``  exact medians from counted values.
* ``mode_values``          most frequent value, ties -> smallest, via
  aggregates only (partial aggregation absorbs hot values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number",
                      num_partitions: int | None = None, columns: Sequence[str] | None = None,
                      copy_to: str | None = None) -> DataFrame:
    """Append ``name`` = 1..n following ``order`` (make it total for determinism).

    One range shuffle; the per-partition counts (one row per partition) give
    each partition its offset, which is broadcast back. ``columns`` are the ones to
    keep (default: all); others are not materialized. With ``copy_to`` the tagged rows go
    to compressed parquet files in that folder instead of a checkpoint, whose rows are
    about three times as large; who names the folder deletes it after the last use.
    """
    n = _partitions(df, num_partitions)
    order = list(order)
    tagged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("__mono", F.monotonically_increasing_id())
                .withColumn("__pid", F.shiftright("__mono", 33)))
    if columns is not None:
        tagged = tagged.select(*[F.col(f"`{c}`") for c in columns], "__mono", "__pid")
    if copy_to:
        tagged.write.option("compression", "zstd").parquet(copy_to)
        tagged = df.sparkSession.read.schema(tagged.schema).parquet(copy_to)
    else:
        tagged = _materialize(tagged)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: ordering this tiny table in one task is bounded.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.col("__mono") - F.shiftleft(F.col("__pid"), 33)
    return (tagged.join(F.broadcast(offsets), "__pid", "inner")
                  .withColumn(name, F.col("__off") + local + 1)
                  .drop("__mono", "__pid", "__off"))


def _materialize(df: DataFrame) -> DataFrame:
    from martline.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _null_safe_eq(cols_a: Sequence[Column], cols_b: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(cols_a, cols_b):
        cond = cond & a.eqNullSafe(b)
    return cond


def fill_ordered(df: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                 partition_by: Sequence[str] = (), direction: str = "forward",
                 num_partitions: int | None = None) -> DataFrame:
    """Carry the last (forward) or next (backward) non-NULL value into NULLs.

    Order is ``order_by`` ascending within each ``partition_by`` group (the
    whole table when empty); make it total for a deterministic result.
    Leading NULLs stay NULL under forward fill, trailing ones under backward.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    cols = list(columns)
    if not cols:
        return df
    keys = list(partition_by)
    original = df.columns
    if any("." in c or "`" in c for c in original):  # names that paths would be read from: others while the work is done
        safe = {c: f"__c{i}" for i, c in enumerate(original)}
        return fill_ordered(df.toDF(*safe.values()), [safe[c] for c in cols], [safe[c] for c in order_by], [safe[c] for c in keys],
                            direction, num_partitions).toDF(*original)
    added_key = False
    if not keys:
        df = df.withColumn("__k", F.lit(0))
        keys, added_key = ["__k"], True
    n = _partitions(df, num_partitions)
    orders = [F.col(o).asc() if direction == "forward" else F.col(o).desc() for o in order_by]
    sort_exprs = [F.col(k).asc_nulls_first() for k in keys] + orders
    tagged = _materialize(df.repartitionByRange(n, *sort_exprs).sortWithinPartitions(*sort_exprs)
                          .withColumn("__mono", F.monotonically_increasing_id()).withColumn("__pid", F.shiftright("__mono", 33)))

    # within a partition: a window per key and partition, so a hot key's window is one partition's share of it
    local_run = Window.partitionBy("__pid", *keys).orderBy("__mono").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumns({c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(local_run) for c in cols})

    # Per partition: first key, last key, and the last key's last values.
    per_key = tagged.groupBy("__pid", *keys).agg(
        F.min("__mono").alias("__from"), F.max("__mono").alias("__to"),
        *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("__mono"))).alias(f"__end_{c}") for c in cols])
    first = F.min_by(F.struct(*[F.col(k) for k in keys]), F.col("__from"))
    last = F.max_by(F.struct(*([F.col(k) for k in keys] + [F.col(f"`__end_{c}`").alias(c) for c in cols])), F.col("__to"))
    summary = per_key.groupBy("__pid").agg(first.alias("__first"), last.alias("__last"))
    by_pid = Window.orderBy("__pid")  # one row per partition: bounded
    run = Window.partitionBy(*[F.col(f"__last.{k}") for k in keys]).orderBy("__pid") \
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summary = summary.select(
        "__pid", "__first", "__last",
        *[F.last(F.col(f"__last.{c}"), ignorenulls=True).over(run).alias(f"__cum_{c}") for c in cols])
    prev_last = F.lag("__last").over(by_pid)
    carry = summary.select(
        "__pid", F.col("__first"),
        F.when(_null_safe_eq([prev_last.getField(k) for k in keys],
                             [F.col(f"__first.{k}") for k in keys]), F.lit(True))
         .otherwise(F.lit(False)).alias("__continues"),
        *[F.lag(f"__cum_{c}").over(by_pid).alias(f"__carry_{c}") for c in cols])

    joined = local.join(F.broadcast(carry), "__pid", "left")
    same_key = _null_safe_eq([F.col(k) for k in keys], [F.col(f"__first.{k}") for k in keys]) \
        & F.col("__continues")
    filled = joined.select(*[
        (F.when(F.col(c).isNull() & same_key, F.col(f"__carry_{c}")).otherwise(F.col(c))
         .cast(df.schema[c].dataType).alias(c)) if c in cols else F.col(f"`{c}`")
        for c in df.columns])
    if added_key:
        filled = filled.drop("__k")
    return filled.select(*[F.col(f"`{c}`") for c in original])


def _medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """(keys, __col, __median) of the non-NULL values, for every group and column (by number) that has any.

    Equal values are counted first (with map-side combine), so only distinct values are ordered: one range shuffle of
    (keys, column, value, count), a running count within each partition, and one row a partition and group to
    carry it over the partitions' borders."""
    keys = list(keys)
    values = F.array(*[F.struct(F.lit(i).alias("__col"), F.col(f"`{c}`").cast("double").alias("__v")) for i, c in enumerate(columns)])
    group = [*keys, "__col"]
    counts = (df.select(*keys, F.explode(values).alias("__x")).select(*keys, "__x.*").where(F.col("__v").isNotNull())
              .groupBy(*group, "__v").agg(F.count(F.lit(1)).alias("__n")))
    order = [*group, "__v"]
    tagged = _materialize(counts.repartitionByRange(_partitions(df, num_partitions), *order).withColumn("__pid", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    border = tagged.groupBy(*group, "__pid").agg(F.sum("__n").alias("__s")).select(
        *group, "__pid", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__off"), F.sum("__s").over(Window.partitionBy(*group)).alias("__total"))
    running = F.sum("__n").over(Window.partitionBy(*group, "__pid").orderBy("__v"))
    end = F.col("__off") + F.col("__run")
    holds = lambda place: (end - F.col("__n") < place) & (place <= end)
    low, high = F.floor((F.col("__total") + 1) / 2), F.floor(F.col("__total") / 2) + 1
    return (tagged.withColumn("__run", running).join(border, [*group, "__pid"]).groupBy(*group)
            .agg(((F.sum(F.when(holds(low), F.col("__v"))) + F.sum(F.when(holds(high), F.col("__v")))) / 2).alias("__median")))


def exact_medians(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None) -> dict[str, float | None]:
    """Exact medians of several columns in one pass (mean of the two middle values when the count is even); None for
    no values."""
    found = {r["__col"]: r["__median"] for r in _medians(df, [], columns, num_partitions).collect()} if columns else {}
    return {c: found.get(i) for i, c in enumerate(columns)}


def exact_median(df: DataFrame, column: str, num_partitions: int | None = None):
    return exact_medians(df, [column], num_partitions)[column]


def grouped_exact_median(df: DataFrame, keys: Sequence[str], column: str, alias: str,
                         num_partitions: int | None = None) -> DataFrame:
    """Per-group exact median; groups with NULL keys are dropped, groups
    without values get NULL. A hot group's distinct values are ordered across many partitions."""
    keys = list(keys)
    base = df.dropna(how="any", subset=keys)
    picked = _medians(base, keys, [column], num_partitions).select(*keys, F.col("__median").alias(alias))
    return base.select(*keys).distinct().join(picked, keys, "left")


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent non-NULL value of each column, smallest value on ties; None when all NULL. One pass for all columns
    of a type: values are counted by (column, value)."""
    out: dict = dict.fromkeys(columns)
    kinds: dict[str, list[str]] = {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in kinds.values():
        values = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").alias("v")) for c in names])
        counts = df.select(F.explode(values).alias("x")).select("x.*").where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("c").agg(F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("v"))
        out.update({r.c: r.v for r in best.collect()})
    return out


def mode_value(df: DataFrame, column: str):
    return mode_values(df, [column])[column]
