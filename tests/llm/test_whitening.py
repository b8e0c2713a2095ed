import math

import numpy as np
import pytest

from martline.llm import whitening

from .helpers import VECTORS


def rows(n=120, size=6, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) * 0.3 + 0.7
    out = [(i, [float(np.float32(c)) for c in v], i % 3, "x", None) for i, v in enumerate(x)]
    odd = [None, [], [None] * size, [float("nan")] + [0.0] * (size - 1), [float("inf")] * size, [1.0, 2.0], [-0.0] * size, [0.0] * size]
    out += [(1000 + i, v, None, None, "y") for i, v in enumerate(odd)]
    return [*out, *[(2000 + i, out[0][1], 1, None, None) for i in range(60)], out[5], out[5], (None, out[7][1], None, None, None)]


def plain(data, size, most):
    valid = [(i, v) for i, v, *_ in data if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * c) + 0 for c in v] for _, v in valid], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1][:most], vectors[:, ::-1][:, :most]
    white = (x - s / n) @ vectors / np.sqrt(e)
    far = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return [i for i, _ in valid], n, far, white, e / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("size,most", [(6, 4), (2, None), (9, 3)])
def test_all_rows_against_a_plain_eigensolver(spark, size, most):
    data = rows(size=size)
    out = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(3), most).collect()
    ids, n, far, white, explained = plain(data, size, most or size)
    k = white.shape[1]
    assert len(out) == len(ids) * k and {r.n for r in out} == {n} and len({r.identity_error for r in out}) == 1
    assert out[0].identity_error < 1e-9
    sign = {}
    expected = sorted((str(i), c + 1, far[r], *np.round(np.abs(white[r, c : c + 1]), 7)) for r, i in enumerate(ids) for c in range(k))
    got = sorted((str(r.vec_id), r.component, int(r.deviation), round(abs(r.whitened), 7)) for r in out)
    for a, b in zip(expected, got, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6)
    first = {(i, c + 1): white[r, c] for r, i in enumerate(ids) for c in range(k)}
    for r in out:  # one sign a component for all rows
        if abs(r.whitened) > 1e-3:
            assert sign.setdefault(r.component, np.sign(r.whitened * first[r.vec_id, r.component])) == np.sign(r.whitened * first[r.vec_id, r.component])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_tables_without_variance_and_empty_ones(spark):
    for data in ([], [(1, None, None, None, None)], [(i, [0.5, 0.25], None, None, None) for i in range(5)], [(1, [], 1, "a", "b")]):
        out = whitening.whiten(spark.createDataFrame(data, VECTORS), 4)
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], None, None, None) for i in range(6)], VECTORS), 4).collect()
    assert {r.component for r in line} == {1} and len(line) == 6 and line[0].explained == pytest.approx(1)


def test_large_entries_stay_exact(spark):
    data = [(i, [float(v), 1e9 if i else 3e38, 0.0], None, None, None) for i, v in enumerate((1e12, -3e12, 5.5, 0.25))]
    out = whitening.whiten(spark.createDataFrame(data, VECTORS), 1).collect()
    x = [[min(math.floor(256 * np.float64(np.float32(c))), 1 << 53) for c in v] for _, v, *_ in data]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert {r.vec_id: int(r.deviation) for r in out} == {i: sum((4 * a - b) ** 2 for a, b in zip(r, s, strict=True)) for i, r in enumerate(x)}


@pytest.mark.parametrize("name", ["random", "equal", "cluster", "singular", "graded"])
def test_divide_and_conquer_finds_all_components(name):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    values = {"random": rng.uniform(size=24), "equal": np.ones(24), "cluster": np.repeat([5, 2, 2 + 1e-9, 1e-3], 6), "singular": np.r_[np.ones(4), np.zeros(20)],
              "graded": np.logspace(0, -12, 24)}[name]
    a = q * values @ q.T
    e, v = whitening.components((a + a.T) / 2)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-14 * 24 and np.abs(v.T @ v - np.eye(24)).max() < 1e-13
    assert np.abs(a @ v - v * e).max() < 1e-13


def test_polar_factor_is_the_sign_of_the_matrix():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    values = np.r_[np.logspace(0, -14, 6), -np.logspace(0, -14, 6)]
    u = whitening.polar((lambda a: (a + a.T) / 2)(q * values @ q.T))
    assert np.abs(u @ u - np.eye(12)).max() < 1e-12
    well = q * np.sign(values) * np.r_[1:7, 1:7] @ q.T
    assert np.abs(whitening.polar((well + well.T) / 2) - q * np.sign(values) @ q.T).max() < 1e-13
