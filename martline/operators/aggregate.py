"""Grouped aggregates: generic (A1) and daily sales (A2)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions import aggregates as reg
from martline.operators.ordered import exact_medians, grouped_exact_median


def _name_of(f: str | reg.CustomAggregate | Callable) -> str:
    return f if isinstance(f, str) else f.name if isinstance(f, reg.CustomAggregate) else f.__name__


def _series_udf(fn: Callable[[pd.Series], float]):  # noqa: ANN202
    def run(s: pd.Series) -> float:
        return fn(s.dropna())

    run.__annotations__ = {"s": pd.Series, "return": float}
    return F.pandas_udf(run, T.DoubleType())


#: Groups whose states a task holds before it gives them out and begins anew.
HELD_GROUPS = 100_000


def aggregate_custom(df: DataFrame, group_by: Sequence[str], aggregations: Mapping[str, Sequence[reg.CustomAggregate]],
                     dropna: bool = True) -> DataFrame:
    """Grouped aggregates written in Python, named ``<column>_<name>`` (§2.13).

    Tasks reduce their rows to one state a group, batch by batch, before anything is shuffled; what meets in one task of a group, however
    large, is a state from each task. Groups then come sorted, so a task holds one at a time."""
    keys, wanted = list(group_by), [(c, a) for c, some in aggregations.items() for a in some]
    columns = list(aggregations)
    base = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)], *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    if dropna:
        for i in range(len(keys)):
            base = base.where(F.col(f"k{i}").isNotNull())
    ks = [f"k{i}" for i in range(len(keys))]
    if not ks:
        base, ks = base.withColumn("k0", F.lit(0)), ["k0"]
    states = T.StructType([*(base.schema[k] for k in ks), T.StructField("state", T.BinaryType())])
    result = T.StructType([*(base.schema[k] for k in ks), *(T.StructField(f"r{i}", T.DoubleType()) for i in range(len(wanted)))])

    def join(a: list, b: list) -> list:
        return [y if x is None else x if y is None else w.merge(x, y) for (_, w), x, y in zip(wanted, a, b, strict=True)]

    def rows(held: list[tuple], schema: T.StructType) -> pd.DataFrame:
        return pd.DataFrame({f.name: pd.Series([r[i] for r in held], dtype=object) for i, f in enumerate(schema)})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        for b in batches:
            for key, part in b.groupby(ks, dropna=False, sort=False):
                key = tuple(None if pd.isna(x) else x for x in key)
                values = {c: part[f"v{i}"].dropna() for i, c in enumerate(columns)}
                new = [w.partial(values[c]) if len(values[c]) else None for c, w in wanted]
                held[key] = join(held[key], new) if key in held else new
            if len(held) > HELD_GROUPS:
                yield rows([(*k, pickle.dumps(s)) for k, s in held.items()], states)
                held = {}
        if held:
            yield rows([(*k, pickle.dumps(s)) for k, s in held.items()], states)

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = None, None, []

        def close() -> tuple:
            return (*now, *[None if s is None and not w.empty else w.final(s) for (_, w), s in zip(wanted, state, strict=True)])

        for b in batches:
            for *key, blob in b.itertuples(index=False):
                key, new = tuple(None if pd.isna(x) else x for x in key), pickle.loads(blob)
                if key == now:
                    state = join(state, new)
                    continue
                if now is not None:
                    out.append(close())
                now, state = key, new
            if len(out) > 10_000:
                yield rows(out, result)
                out = []
        if now is not None:
            out.append(close())
        if out:
            yield rows(out, result)

    out = base.mapInPandas(partial, states).repartition(*ks).sortWithinPartitions(*ks).mapInPandas(final, result)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], *[F.col(f"r{i}").alias(f"{c}_{w.name}") for i, (c, w) in enumerate(wanted)])


def aggregate_data(df: DataFrame, group_by: Sequence[str], aggregations: Mapping[str, Sequence[str | reg.CustomAggregate | Callable]],
                   order_by: Sequence[str] | None = None, dropna: bool = True,
                   sort: bool = False) -> DataFrame:
    """``groupBy(keys).agg(...)`` with outputs named ``<column>_<function>``.

    NULL group keys are dropped (``dropna``), as pandas does by default.
    A missing column or unknown function is an error (no partial result). Functions are names, ``CustomAggregate`` objects, or
    plain Python functions of a group's whole series (non-null values; those meet in one task, so only for groups of bounded size).
    ``sort=True`` orders by the keys (a range shuffle over the groups).
    """
    keys = list(group_by)
    missing = [c for c in list(keys) + list(aggregations) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found for aggregation: {missing}")
    custom = {c: [f for f in fs if isinstance(f, reg.CustomAggregate)] for c, fs in aggregations.items()}
    whole = {c: [f for f in fs if callable(f)] for c, fs in aggregations.items()}
    wanted = [f"{c}_{_name_of(f)}" for c, fs in aggregations.items() for f in fs]
    aggregations = {c: [f for f in fs if isinstance(f, str)] for c, fs in aggregations.items()}
    for col, funcs in aggregations.items():
        for f in funcs:
            if not reg.known(f):
                raise ValueError(f"unknown aggregate {f!r} for column {col!r}")
    base = df
    if dropna:
        for k in keys:
            base = base.where(F.col(k).isNotNull())

    plain, medians, names = [], [], []
    for col, funcs in aggregations.items():
        for f in funcs:
            name = f"{col}_{f}"
            names.append(name)
            if f in reg.RANKED:
                medians.append((col, name))
            else:
                plain.append(reg.build(f, col, order_by).alias(name))
    if plain:
        out = base.groupBy(*keys).agg(*plain)
    elif keys:
        out = base.select(*keys).distinct()
    else:
        out = base.agg(F.count(F.lit(1)).alias("__rows"))
    scalars = exact_medians(base, [col for col, _ in medians]) if medians and not keys else {}
    for col, name in medians:
        if keys:
            out = out.join(grouped_exact_median(base, keys, col, name), keys, "left")
        else:  # one group: the median is a scalar, found from global ranks
            out = out.withColumn(name, F.lit(scalars[col]).cast("double"))
    out = out.select(*keys, *names)
    beside = []
    if any(custom.values()):
        beside.append(aggregate_custom(base, keys, {c: fs for c, fs in custom.items() if fs}, dropna))
    if any(whole.values()):
        beside.append(base.groupBy(*keys).agg(*[_series_udf(f)(F.col(f"`{c}`").cast("double")).alias(f"{c}_{_name_of(f)}") for c, fs in whole.items() for f in fs]))
    for own in beside:
        if keys:
            mine = own.select(*[F.col(f"`{k}`").alias(f"__{k}") for k in keys], *own.columns[len(keys):])
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys]
            out = out.join(mine, same, "left").drop(*[f"__{k}" for k in keys])
        else:
            out = out.join(own, how="left")  # one row on either side
    out = out.select(*keys, *wanted)
    return out.orderBy(*keys) if sort and keys else out


def aggregate_daily_sales(sales: DataFrame, date_column: str = "order_date") -> DataFrame:
    """Per calendar day: quantity_sum, total_amount_sum, final_amount_sum, order_count."""
    if date_column not in sales.columns:
        raise ValueError(f"date column {date_column!r} not found")
    return (sales.groupBy(F.to_date(F.col(date_column)).alias("date"))
                 .agg(F.coalesce(F.sum("quantity"), F.lit(0).cast("long")).alias("quantity_sum"),
                      F.coalesce(F.sum("total_amount"), F.lit(0)).alias("total_amount_sum"),
                      F.coalesce(F.sum("final_amount"), F.lit(0)).alias("final_amount_sum"),
                      F.count("order_id").alias("order_count")))
