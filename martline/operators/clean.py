"""Cleaning operators.

Duplicates are removed with aggregates, not windows: ``groupBy(keys)`` with
``min_by``/``max_by`` keeps the first/last row per key and benefits from
partial aggregation, so one hot key does not land whole in one task.
"Row order" is always an explicit ``order_by`` (Spark rows have no index).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.dates import FORMATS, choose_formats, parse_timestamp
from martline.functions.text import normalize_email, strip
from martline.operators.ordered import exact_medians, fill_ordered, mode_values


def _q(c: str) -> str:
    return f"`{c}`"


#: Different rows with copies, up to which ``remove_duplicates`` compares only those rows whole.
MAX_COPIED = 100_000


#: Types whose equal values have one ``xxhash64`` (text that is collated has not).
HASHED = (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _by_hashes(df: DataFrame) -> bool:
    """Whether rows that Spark groups together also have one ``xxhash64``."""
    return all(isinstance(f.dataType, HASHED) or f.dataType.simpleString() == "string" for f in df.schema)


def remove_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first",
                      order_by: Sequence[str] | None = None, reread: bool = False) -> DataFrame:
    """Drop duplicate rows on ``subset`` (all columns when None); NULLs compare equal.

    keep='first'/'last' keeps the row that is first/last in ``order_by``
    (required with a subset); keep=False drops every member of a duplicated group.
    ``reread`` says that ``df`` is cheap to read again and gives the same rows (as files do): see ``_drop_copies``.
    """
    cols = df.columns
    keys = list(subset) if subset else list(cols)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"duplicate subset not in frame: {missing}")
    if keep not in ("first", "last", False):
        raise ValueError("keep must be 'first', 'last' or False")
    rest = [c for c in cols if c not in keys]
    if keep is False:
        g = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(
            F.count(F.lit(1)).alias("__n"),
            *([F.any_value(F.struct(*[F.col(_q(c)) for c in rest])).alias("__r")] if rest else []))
        g = g.where(F.col("__n") == 1)
    elif not rest:
        return _drop_copies(df) if reread and _by_hashes(df) else df.dropDuplicates()
    else:
        if not order_by:
            raise ValueError("keep='first'/'last' on a subset needs order_by")
        order = F.struct(*[F.col(_q(c)) for c in order_by])
        pick = F.min_by if keep == "first" else F.max_by
        g = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(
            pick(F.struct(*[F.col(_q(c)) for c in rest]), order).alias("__r"))
    return g.select(*[F.col(_q(c)) if c in keys else F.col(f"__r.{_q(c)}").alias(c) for c in cols])


def _drop_copies(df: DataFrame) -> DataFrame:
    """``df.dropDuplicates()`` that moves only the rows' hashes, in a job of its own, and then only rows whose hash comes more than
    once (copies have one hash; different rows that share one are told apart by the whole row). The other rows stay where they
    are, so what follows needs no shuffle for the duplicates. With more than ``MAX_COPIED`` such hashes all rows are shuffled."""
    h = f"__h_{uuid.uuid4().hex[:8]}"
    names = [F.col(_q(c)) for c in df.columns]
    # as grouping does: no negative zeros
    plain = df.select(*[(F.col(_q(f.name)) + F.lit(0).cast(f.dataType)).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType))
                        else F.col(_q(f.name)) for f in df.schema])
    counts = df.groupBy(F.xxhash64(*names).alias(h)).agg(F.count(F.lit(1)).alias("n"))
    copied = counts.where("n > 1").limit(MAX_COPIED + 1).agg(F.collect_list(h)).first()[0]  # all partitions at once
    if not copied:
        return plain
    if len(copied) > MAX_COPIED:
        return df.dropDuplicates()
    hashes = F.broadcast(df.sparkSession.createDataFrame([(x,) for x in copied], f"{h} long"))
    tagged = plain.withColumn(h, F.xxhash64(*names))
    return tagged.join(hashes, h, "left_anti").drop(h).unionByName(tagged.join(hashes, h, "left_semi").drop(h).dropDuplicates())


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def column_mean(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Means in one pass; DECIMAL columns are summed exactly, divided in DOUBLE."""
    aggs = []
    for c in columns:
        dt = df.schema[c].dataType
        if isinstance(dt, T.DecimalType):
            aggs.append(F.try_divide(F.sum(_q(c)).cast("double"), F.count(_q(c)).cast("double")).alias(c))
        else:
            aggs.append(F.avg(F.col(_q(c)).cast("double")).alias(c))
    row = df.agg(*aggs).first()
    return {c: row[c] for c in columns}


def handle_nulls(df: DataFrame, strategy: str = "fill", fill_value: Any = None,
                 fill_method: str | None = None, columns: Sequence[str] | None = None,
                 order_by: Sequence[str] | None = None, partition_by: Sequence[str] = (),
                 approx_median: bool = False) -> DataFrame:
    """C2-C7. strategy: 'drop' (any NULL in ``columns``), 'fill', 'skip'.

    fill_method: mean / median (numeric columns only; others fall through to
    ``fill_value``), mode (any type, ties -> smallest, all-NULL unchanged),
    forward / backward (ordered by ``order_by`` within ``partition_by``).
    Without a method or value, 'fill' changes nothing (as the reference's default).
    Mean/median fills turn the column into DOUBLE.
    """
    cols = [c for c in (columns or df.columns) if c in df.columns]
    if strategy == "skip":
        return df
    if strategy == "drop":
        return df.dropna(how="any", subset=cols)
    if strategy != "fill":
        raise ValueError("strategy must be 'fill', 'drop' or 'skip'")
    if fill_method in ("forward", "backward"):
        if not order_by:
            raise ValueError("forward/backward fill needs order_by")
        return fill_ordered(df, cols, order_by, partition_by, direction=fill_method)

    values: dict[str, Any] = {}
    as_double: set[str] = set()
    if fill_method in ("mean", "median"):
        num = [c for c in cols if _numeric(df.schema[c].dataType)]
        if fill_method == "mean":
            stats = column_mean(df, num)
        elif approx_median:
            row = df.agg(*[F.percentile_approx(F.col(_q(c)).cast("double"), 0.5, 100000).alias(c)
                           for c in num]).first()
            stats = {c: row[c] for c in num}
        else:
            stats = exact_medians(df, num)
        for c in num:
            if stats[c] is not None:
                values[c] = float(stats[c])
                as_double.add(c)
        rest = [c for c in cols if c not in num]
        if fill_value is not None:
            values.update({c: fill_value for c in rest})
    elif fill_method == "mode":
        values = {c: m for c, m in mode_values(df, cols).items() if m is not None}
    elif fill_method is not None:
        raise ValueError(f"unknown fill_method {fill_method!r}")
    elif fill_value is not None:
        values = {c: fill_value for c in cols}

    if not values:
        return df
    out = []
    for f in df.schema.fields:
        c = f.name
        if c not in values:
            out.append(F.col(_q(c)))
        elif c in as_double:
            out.append(F.coalesce(F.col(_q(c)).cast("double"), F.lit(values[c])).alias(c))
        else:
            out.append(F.coalesce(F.col(_q(c)), F.lit(values[c]).cast(f.dataType)).alias(c))
    return df.select(out)


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_whitespace(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip leading/trailing whitespace of string columns (listed ones, or all)."""
    strings = set(_string_columns(df))
    targets = [c for c in (columns or df.columns) if c in strings]
    if not targets:
        return df
    return df.withColumns({c: strip(F.col(_q(c))) for c in targets})


def standardize_dates(df: DataFrame, date_columns: Sequence[str], format: str | None = None) -> DataFrame:  # noqa: A002
    """Parse to TIMESTAMP_NTZ with ``format``, or with one format a column, chosen by an aggregate over the whole
    table (``dates.choose_formats``; a mixed column is an error); what doesn't parse -> NULL.
    Absent columns are skipped; date/timestamp columns are only cast."""
    repl = {}
    texts = []
    for c in dict.fromkeys(date_columns):
        if c not in df.columns:
            continue
        dt = df.schema[c].dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            repl[c] = F.col(_q(c)).cast(T.TimestampNTZType())
        elif format:
            repl[c] = parse_timestamp(F.col(_q(c)), format)
        else:
            texts.append(c)
    for c, name in choose_formats(df, texts).items():
        repl[c] = parse_timestamp(F.col(_q(c)), FORMATS[name])
    return df.withColumns(repl) if repl else df


def standardize_emails(df: DataFrame, email_columns: Sequence[str]) -> DataFrame:
    """Lower case then strip; absent columns skipped; NULL stays NULL."""
    repl = {c: normalize_email(F.col(_q(c))) for c in email_columns if c in df.columns}
    return df.withColumns(repl) if repl else df


def clean_all(df: DataFrame, remove_duplicates_: bool = True, handle_nulls_: bool = True,
              null_strategy: str = "fill", trim_whitespace_: bool = True,
              standardize_dates_: Sequence[str] | None = None,
              standardize_emails_: Sequence[str] | None = None, reread: bool = False, **null_options: Any) -> DataFrame:
    """C11: dedupe (all columns) -> nulls -> trim -> dates -> emails, each switchable. ``reread`` as in ``remove_duplicates``."""
    out = df
    if remove_duplicates_:
        out = remove_duplicates(out, reread=reread)
    if handle_nulls_:
        out = handle_nulls(out, strategy=null_strategy, **null_options)
    if trim_whitespace_:
        out = trim_whitespace(out)
    if standardize_dates_:
        out = standardize_dates(out, standardize_dates_)
    if standardize_emails_:
        out = standardize_emails(out, standardize_emails_)
    return out
