"""Aggregate-function registry for the generic grouped aggregate (A1).

Names follow the pandas ``groupby().agg`` vocabulary; each maps to a built-in
Spark aggregate so the plan keeps partial (map-side) aggregation. Fixed
semantics: ``sum`` of an all-NULL group is 0 and ``prod`` of one is 1 (pandas
``min_count=0``); ``std``/``var`` use n-1; ``count`` ignores NULLs while
``size`` counts rows; ``first``/``last`` are the first/last non-NULL value in
``order_by`` order; ``nunique_approx`` is a HyperLogLog++ estimate (1% error)
for very high cardinalities. ``median`` is exact and handled by a ranking plan, not a
single aggregate (see ``martline.operators.aggregate``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _order_struct(order_by: Sequence[str] | None) -> Column:
    if not order_by:
        raise ValueError("first/last need an explicit order_by (row order is not defined in Spark)")
    return F.struct(*[F.col(c) for c in order_by])


def _first(c: str, order_by):
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _order_struct(order_by)))


def _last(c: str, order_by):
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), _order_struct(order_by)))


REGISTRY: dict[str, Callable[[str, Sequence[str] | None], Column]] = {
    "sum": lambda c, o: F.coalesce(F.sum(c), F.lit(0).cast("long")),
    "mean": lambda c, o: F.avg(c),
    "count": lambda c, o: F.count(c),
    "size": lambda c, o: F.count(F.lit(1)),
    "min": lambda c, o: F.min(c),
    "max": lambda c, o: F.max(c),
    "std": lambda c, o: F.stddev_samp(c),
    "var": lambda c, o: F.var_samp(c),
    "nunique": lambda c, o: F.count_distinct(c),
    "nunique_approx": lambda c, o: F.approx_count_distinct(c, 0.01),
    "first": _first,
    "last": _last,
    "prod": lambda c, o: F.coalesce(F.product(c), F.lit(1.0)),
}

ORDERED = {"first", "last"}
RANKED = {"median"}


def known(name: str) -> bool:
    return name in REGISTRY or name in RANKED


def build(name: str, column: str, order_by: Sequence[str] | None = None) -> Column:
    if name not in REGISTRY:
        raise ValueError(f"unknown aggregate {name!r}; known: {sorted(set(REGISTRY) | RANKED)}")
    return REGISTRY[name](column, order_by)


@dataclass(frozen=True)
class CustomAggregate:
    """An aggregate written in Python that works in parts: ``partial`` turns some of a group's values (a non-empty series without nulls)
    into a state (a tuple of numbers), ``merge`` makes one state of two, in any order, and ``final`` gives the result (a number
    or None). A group without values gives ``final(None)`` where ``empty`` is set, else null."""

    name: str
    partial: Callable[[pd.Series], tuple]
    merge: Callable[[tuple, tuple], tuple]
    final: Callable[[tuple | None], float | None]
    empty: bool = False


GEOMETRIC_MEAN = CustomAggregate("gmean", lambda s: (float(_logs(s).sum()), len(s)), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                                 lambda t: float(_exp(t[0] / t[1])))
HARMONIC_MEAN = CustomAggregate("hmean", lambda s: (float((1 / s.astype(float)).sum()), len(s)), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                                lambda t: t[1] / t[0])


def _logs(s: pd.Series) -> pd.Series:
    import numpy as np

    return np.log(s.astype(float))


def _exp(x: float) -> float:
    import math

    return math.exp(x)


#: log2 of a distinct sketch's registers: relative standard error about 1.04 / 2^(K/2), 0.8 %.
SKETCH_K = 14


def distinct_sketch(column: str) -> Column:
    """Mergeable sketch (binary, at most about 2^K bytes) of a column's different values; null values don't count."""
    return F.hll_sketch_agg(F.col(column), SKETCH_K)


def distinct_of(sketch: str) -> Column:
    """Estimated number of different values in all of a group's sketches together."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch, True))
