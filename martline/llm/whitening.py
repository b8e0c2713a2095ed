"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors are read in fixed point (256ths), so counts and sums are exact. The fit is over each different vector once: Spark makes them
distinct, sums them, and sums the products of the centred vectors. The covariance, as large as the vectors' dimension squared, is taken
apart on the driver without an eigensolver: the polar factor U of the covariance less a shift (``polar``, by dynamically weighted
Halley iterations) gives the projector (U + 1) / 2 on the space of the eigenvalues above the shift; bases of this space and of its
complement cut the problem in two (``divide``), down to single components. Mean and components are sent to all tasks, which whiten
every vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import discard, ship, written

#: Fixed point: units of an entry's 1; larger entries (of 2^45 and more) saturate.
UNITS, MOST = 256.0, float(1 << 53)
#: An eigenvalue below this share of the largest is 0.
NONE = 1e-12


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix (its sign function) by QDWH: each step is a weighted Halley step, done by one
    QR decomposition; the weights follow a lower bound of the smallest singular value. Seven steps reach double precision."""
    n, eps = len(a), np.finfo(float).eps
    x, low = a / np.linalg.norm(a), eps
    for _ in range(12):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        w = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))) / 2
        p = (w - 1) ** 2 / 4
        c = w + p - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))
        new = p / c * x + (w - p / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (w + p * low * low) / (1 + c * low * low))
        if abs(1 - low) < 10 * eps and moved < np.cbrt(5 * eps):
            break
    return x


def _shifts(diagonal: np.ndarray) -> Iterator[float]:
    """Where to cut: near the median, then ever other places; the mean has eigenvalues on both sides unless all are equal."""
    low, high, mean = diagonal.min(), diagonal.max(), diagonal.mean()
    yield float(np.median(diagonal))
    yield float(mean)
    for t in (0.25, 0.75, 0.4, 0.6, 0.1, 0.9, 0.01, 0.99):
        yield float(low + t * (high - low))


def divide(a: np.ndarray, scale: float | None = None) -> np.ndarray:
    """Orthogonal matrix whose columns are eigenvectors of a symmetric matrix, in no order.

    A block that is a multiple of the identity, to rounding, is not divided further: any basis will do."""
    n = len(a)
    scale = float(np.linalg.norm(a)) if scale is None else scale
    eps = np.finfo(float).eps
    spread = float(np.linalg.norm(a - np.eye(n) * np.trace(a) / n))
    if n == 1 or spread <= 4 * eps * scale:
        return np.eye(n)
    best = None
    for shift in _shifts(np.diag(a)):
        b = a - shift * np.eye(n)
        if not np.linalg.norm(b):
            continue
        projector = (polar(b) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        # a basis of the projector's range (k columns) and of the rest, by subspace iteration from a fixed start
        q = np.linalg.qr(projector @ np.random.default_rng(n).normal(size=(n, k)), mode="complete")[0]
        for _ in range(2):
            q = np.linalg.qr(projector @ q[:, :k], mode="complete")[0]
        off = float(np.linalg.norm(q[:, k:].T @ a @ q[:, :k]))
        if best is None or off < best[0]:
            best = off, k, q
        if off <= 64 * eps * scale * np.sqrt(n):
            break
    if best is None:  # no gap anywhere: the block's eigenvalues are equal to rounding
        return np.eye(n)
    _, k, q = best
    out = np.zeros((n, n))
    for part in (slice(0, k), slice(k, n)):
        sub = q[:, part].T @ a @ q[:, part]
        out[:, part] = q[:, part] @ divide((sub + sub.T) / 2, scale)
    return out


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns, the largest entry of each positive). One round of refinement takes what
    rounding has left off the diagonal to the first order."""
    v = divide(covariance)
    for _ in range(2):
        small = v.T @ covariance @ v
        e = np.diag(small)
        gap = e[None, :] - e[:, None]
        off = small - np.diag(e)
        with np.errstate(divide="ignore", invalid="ignore"):
            turn = np.where(np.abs(gap) > 1e3 * np.abs(off), off / gap, 0.0)
        v, r = np.linalg.qr(v + v @ np.nan_to_num(turn))
        v = v * np.where(np.diag(r) < 0, -1, 1)
    e = np.einsum("ij,ij->j", v, covariance @ v)
    order = np.argsort(-e, kind="stable")
    v = v[:, order]
    return e[order], v * np.where(v[np.abs(v).argmax(axis=0), np.arange(len(v))] < 0, -1, 1)


def _fixed(values: np.ndarray) -> np.ndarray:
    """floor(256 c) of entries, exact (products with 256 are)."""
    return np.clip(np.floor(values.astype(float) * UNITS), -MOST, MOST).astype(np.int64)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _decode(column: pa.Array, size: int) -> np.ndarray:
    """Vectors from their bytes, 16 or 64 bits an entry."""
    rows = column.to_pylist()
    out = np.empty((len(rows), size), np.int64)
    for i, b in enumerate(rows):
        out[i] = np.frombuffer(b, "<i2" if len(b) == 2 * size else "<i8")
    return out


def _encoded(size: int) -> Callable:
    """A vector's fixed-point entries as bytes, the same for equal vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _fixed(_matrix(b.column(0), size))
            short = (np.abs(x) < 1 << 15).all(axis=1)
            small = x.astype("<i2")
            rows = [small[i].tobytes() if s else x[i].tobytes() for i, s in enumerate(short.tolist())]
            yield pa.record_batch([pa.array(rows, pa.binary())], names=["x"])

    return run


def _sums(size: int) -> Callable:
    """(dim, n, total) of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for b in batches:
            x = _decode(b.column(0), size)
            for at in range(0, len(x), 512):  # 2^53 times 2^9 still fits
                total = [a + s for a, s in zip(total, x[at : at + 512].sum(axis=0).tolist(), strict=True)]
            n += len(x)
        if n:
            yield pa.record_batch([pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array([str(t) for t in total])],
                                  names=["dim", "n", "total"])

    return run


def _products(size: int, centre: np.ndarray) -> Callable:
    """(i, j, value): sums of products of the entries less a whole-numbered centre, i <= j. Such products and their sums are whole
    numbers, exact and the same in any order as long as they stay under 2^53."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            y = (_decode(b.column(0), size) - centre).astype(float)
            total += y.T @ y
        i, j = np.triu_indices(size)
        some = total[i, j] != 0
        yield pa.record_batch([pa.array(i[some].astype(np.int32)), pa.array(j[some].astype(np.int32)), pa.array(total[i, j][some])], names=["i", "j", "value"])

    return run


def _spread(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, in whole numbers of any size."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if largest < 1 << 62:
        a = n * x - np.array(sums, np.int64)
        if (int(np.abs(a).max(initial=0)) ** 2) * x.shape[1] < 1 << 63:
            return (a * a).sum(axis=1).tolist()
        a = a.astype(object)
    else:
        a = n * x.astype(object) - np.array(sums, object)
    return (a * a).sum(axis=1).tolist()


def _square(pairs: list, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    for r in pairs:
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, most: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row per valid vector and component, components by
    falling variance up to ``most`` (default: all).

    Null vectors, those with null or non-finite entries, and empty ones are left out, as are vectors of another length than the
    table's most frequent one (of two the larger), which have no place in one covariance. Rows that repeat an id or a vector each
    get rows of their own; the fit takes different vectors once. A component without variance has no whitened form and no rows; so a
    table with one different vector, or none, gives none. Of equal variances any basis may come. ``deviation`` is null beyond 38
    digits."""
    spark = df.sparkSession
    ship(spark)
    valid = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = valid.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).where("size > 0").orderBy(F.desc("n"), F.desc("size")).first()
    if lengths is None:
        return spark.createDataFrame([], OUT)
    size = lengths["size"]
    valid = valid.where(F.size("v") == size)
    fit = written(valid.select("v").mapInArrow(_encoded(size), "x binary").distinct(), "whitening")
    sums = fit.mapInArrow(_sums(size), "dim int, n long, total string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()  # one a dimension
    n, total = sums[0]["n"], [int(r["total"]) for r in sums]
    centre = np.array([(2 * t + n) // (2 * n) for t in total], np.int64)  # the mean's nearest whole number
    rest = np.array([(t - n * int(c)) / n for t, c in zip(total, centre, strict=True)])
    pairs = fit.mapInArrow(_products(size, centre), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    covariance = _square(pairs, size) / n - np.outer(rest, rest)
    e, v = components(covariance)
    trace = float(np.trace(covariance))
    some = np.flatnonzero(e > NONE * max(float(e[0]), 0.0))[:most] if trace > 0 else np.zeros(0, int)
    if not len(some):
        discard(spark, fit)
        return spark.createDataFrame([], OUT)
    k, white, explained = len(some), v[:, some] / np.sqrt(e[some]), e[some] / trace

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - centre).astype(float) - rest) @ white

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k + 1, k + 1))
        for b in batches:
            z = project(_decode(b.column(0), size))
            z = np.hstack([z, np.ones((len(z), 1))])
            out += z.T @ z
        i, j = np.triu_indices(k + 1)
        yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(out[i, j])], names=["i", "j", "value"])

    second = _square(fit.mapInArrow(moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect(), k + 1) / n
    error = float(np.abs(second[:k, :k] - np.outer(second[:k, k], second[:k, k]) - np.eye(k)).max())
    discard(spark, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(1, k + 1, dtype=np.int32)
        for b in batches:
            rows = b.num_rows
            x = _fixed(_matrix(b.column(1), size))
            far = pa.array([d if d < 10**38 else None for d in _spread(x, n, total)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.record_batch([b.column(0).take(each), pa.array(np.tile(number, rows)), pa.array(np.full(rows * k, n)), pc.take(far, each),
                                   pa.array(project(x).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                                  names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return valid.mapInArrow(run, OUT)
