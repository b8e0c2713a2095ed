"""Equi-joins with the pandas-merge contract.

* ``how`` in {inner, left, right, outer/full}.
* Key pairs with the same name on both sides come out as one column (for
  right joins the right value, for full joins the coalesced value); pairs with
  different names keep both columns.
* Overlapping non-key columns get ``suffixes`` (default ``_x`` / ``_y``).
* ``null_safe=True`` matches NULL keys with NULL keys (pandas does); the
  default is SQL equality.

Strategy is left to Catalyst: a side under ``spark.sql.autoBroadcastJoinThreshold``
(a size check on plan statistics) is broadcast, AQE re-plans at runtime and
splits skewed sort-merge partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HOW = {"inner": "inner", "left": "left", "right": "right", "outer": "full_outer",
        "full": "full_outer", "full_outer": "full_outer"}


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_data(left: DataFrame, right: DataFrame, left_on: str | Sequence[str],
              right_on: str | Sequence[str], how: str = "inner",
              suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = False) -> DataFrame:
    if how not in _HOW:
        raise ValueError(f"unsupported join type {how!r}; expected one of {sorted(_HOW)}")
    jtype = _HOW[how]
    lk, rk = _as_list(left_on), _as_list(right_on)
    if len(lk) != len(rk) or not lk:
        raise ValueError("left_on and right_on must name the same, non-zero number of columns")
    for c in lk:
        if c not in left.columns:
            raise ValueError(f"left key {c!r} not in {left.columns}")
    for c in rk:
        if c not in right.columns:
            raise ValueError(f"right key {c!r} not in {right.columns}")

    shared_keys = {a for a, b in zip(lk, rk) if a == b}
    overlap = (set(left.columns) & set(right.columns)) - shared_keys
    lsuf, rsuf = suffixes

    # Rename everything on the right to private names, join on explicit
    # conditions, then project the pandas-shaped result.
    rmap = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    r = right.select([F.col(f"`{c}`").alias(a) for c, a in rmap.items()])
    lmap = {c: f"__l{i}" for i, c in enumerate(left.columns)}
    l = left.select([F.col(f"`{c}`").alias(a) for c, a in lmap.items()])

    conds: list[Column] = []
    for a, b in zip(lk, rk):
        lc, rc = F.col(lmap[a]), F.col(rmap[b])
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    joined = l.join(r, cond, jtype)

    out: list[Column] = []
    for c in left.columns:
        if c in shared_keys:
            if jtype == "right":
                expr = F.col(rmap[c])
            elif jtype == "full_outer":
                expr = F.coalesce(F.col(lmap[c]), F.col(rmap[c]))
            else:
                expr = F.col(lmap[c])
            out.append(expr.alias(c))
        elif c in overlap:
            out.append(F.col(lmap[c]).alias(c + lsuf))
        else:
            out.append(F.col(lmap[c]).alias(c))
    for c in right.columns:
        if c in shared_keys:
            continue
        out.append(F.col(rmap[c]).alias(c + rsuf if c in overlap else c))
    return joined.select(out)


def enrich_with_lookup(df: DataFrame, lookup: DataFrame, df_key: str, lookup_key: str,
                       lookup_columns: Sequence[str], prefix: str | None = None) -> DataFrame:
    """Left join a column subset of ``lookup`` (optionally ``prefix_``-renamed).

    Duplicate lookup keys multiply rows, as a merge does. When the key names
    differ, the lookup key column is dropped from the result.
    """
    cols = list(lookup_columns)
    sub = lookup.select([F.col(lookup_key)] + [
        F.col(c).alias(f"{prefix}_{c}" if prefix else c) for c in cols])
    if prefix and lookup_key in cols:
        raise ValueError("the lookup key cannot also be a prefixed lookup column")
    out = join_data(df, sub, df_key, lookup_key, how="left")
    if df_key != lookup_key:
        out = out.drop(lookup_key)
    return out
