import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import neighbours, pivots
from tests.llm.helpers import VECTORS, union_find


def vectors(seed=0, n=300, dim=16):
    """Clusters of near copies, exact copies, ties, and every kind of unusable vector."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        x = centre[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 1.0])
        rows.append((i, x.astype(np.float32).tolist(), int(rng.integers(3)) if i % 11 else None, "x", "y"))
    copy = rows[5][1]
    rows += [(n + i, copy, rows[5][2], None, None) for i in range(20)]
    bad = [None, [], [0.0] * dim, [math.nan] + [1.0] * (dim - 1), [math.inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    rows += [(n + 20 + i, v, 1, None, None) for i, v in enumerate(bad)]
    rows += [(n + 40, [1.0, 2.0], 1, "a", "b"), (n + 41, [1.0, 2.0], 1, "a", "b"), (n + 60, [2.0], 1, "a", "b"), rows[8], (None, copy, rows[5][2], None, None)]
    return rows


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def product(a, b):
    """Inner product, added in order (the built-in sum of floats compensates)."""
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        total += x * y
    return total


def unique(rows):
    return {r[0]: r for r in rows if r[0] is not None}


@pytest.mark.parametrize("cell", [pivots.CELL, 8])
def test_pivots_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(pivots, "CELL", cell)  # also with lists cut into cells
    rows = unique(vectors())
    ids = sorted(rows)
    ok = [i for i in ids if usable(rows[i][1]) and rows[i][2] is not None]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(np.array(rows[i][1])) for i in ok}
    pairs = [(a, b) for k, a in enumerate(ok) for b in ok[:k] if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    place = {i: k for k, i in enumerate(ids)}
    root = union_find(len(ids), [(place[a], place[b]) for a, b in pairs])
    links = {i: sum(i in p for p in pairs) for i in ids}
    got = {r.vec_id: r for r in pivots.near_duplicates(spark.createDataFrame(vectors(), VECTORS)).collect()}
    assert set(got) == {*ids, None} and got[None].n_links == 0 and got[None].component_id is None
    assert sum(links.values()) > 500
    for i in ids:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], ids[root[place[i]]], ids[root[place[i]]] == i), i


def test_pivots_recall_on_the_table(spark, sf):
    """Recall against brute force over all pairs of a label (0.9 is asked)."""
    from martline.llm.queries import QUERIES

    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.array(t.embedding.tolist(), np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (((x @ x.T) >= 0.98) & (t.label.values[:, None] == t.label.values[None, :])).sum(axis=1) - 1
    got = QUERIES["op1_pivots"](spark, sf).toPandas().set_index("vec_id").loc[t.vec_id]
    assert (got.n_links.values <= links).all() and got.n_links.sum() >= 0.9 * links.sum()


def test_empty_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert pivots.near_duplicates(empty).count() == 0
    assert neighbours.nearest(empty, F.col("id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0], 1, None, None), (7, None, 1, None, None)], VECTORS)
    assert neighbours.nearest(alone, F.col("id") % 20 == 0).count() == 0
    assert [tuple(r) for r in pivots.near_duplicates(alone).orderBy("vec_id").collect()] == [(7, 0, 7, True), (20, 0, 20, True)]


@pytest.mark.parametrize("tile,stripe,block", [(neighbours.TILE, neighbours.STRIPE, neighbours.QUERY_BLOCK), (16, 50, 7)])
def test_neighbours_equal_brute_force(spark, monkeypatch, tile, stripe, block):
    for name, value in (("TILE", tile), ("STRIPE", stripe), ("QUERY_BLOCK", block)):
        monkeypatch.setattr(neighbours, name, value)
    rows = unique(vectors(1))
    ok = {i: np.array(r[1], np.float64) for i, r in rows.items() if usable(r[1])}
    want = set()
    for q in (i for i in ok if i % 20 == 0):
        scored = sorted((-product(ok[q], v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:20], 1)}
    got = neighbours.nearest(spark.createDataFrame(vectors(1), VECTORS), F.col("id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(40, 32)) * 10.0 ** rng.integers(-3, 4, (40, 1)), rng.standard_cauchy(size=(60, 32))
    near, off = neighbours.bounds(neighbours.Coded(q), neighbours.Coded(c))
    assert (np.abs(q @ c.T - near) <= off).all()


def test_spread_and_random_pairs_share_pivots():
    rng = np.random.default_rng(random.Random(1).randrange(9))
    x = pivots.unit(rng.normal(size=(500, 8)))
    p = pivots.spread(x, 20)
    assert len(p) == 20 and len({tuple(v) for v in p.tolist()}) == 20
