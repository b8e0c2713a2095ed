"""Nearest neighbours by inner product: block matrix join with int8 tiles and quantisation bounds.

Queries are dealt into blocks, all vectors into stripes, and each (block, stripe) is one cell of the matrix product.
Within a cell, a stripe is taken tile by tile: the product of int8 codes (exact: whole numbers in
a float product) and the norms of the rounding errors give an upper and a lower bound of every inner product. Pairs
whose upper bound is below the query's 20th best so far are dropped; the others are computed again in double
precision, and a heap per query keeps the best. The heaps of the stripes are merged at the end. The result is exact.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import ship, written

QUERY_BLOCK = 4096
STRIPE = 16384
TILE = 2048

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(v: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
            & F.exists(v, lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a double matrix."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Coded:
    """int8 codes (held as floats for the product), their step, and the norms the bounds need."""

    def __init__(self, x: np.ndarray) -> None:
        self.step = np.abs(x).max(axis=1) / 127
        code = np.rint(x / np.maximum(self.step, np.finfo(float).tiny)[:, None])
        kind = np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64
        back = code * self.step[:, None]
        self.code, self.norm, self.error = code.astype(kind), np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def bounds(q: Coded, c: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products and the greatest possible error of each."""
    near = (q.code @ c.code.T).astype(np.float64) * q.step[:, None] * c.step[None, :]
    off = q.error[:, None] * (c.norm + c.error)[None, :] + q.norm[:, None] * c.error[None, :]
    return near, off * (1 + 1e-9) + 1e-12 * (q.norm + q.error)[:, None] * (c.norm + c.error)[None, :]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, components added in order."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


def cell(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each query a heap of its k best (score, -id) in the stripe, the worst first."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_id]
    least = np.full(len(q_id), -np.inf)
    coded = Coded(q)
    for at in range(0, len(c_id), TILE):
        ids, x = c_id[at : at + TILE], c[at : at + TILE]
        near, off = bounds(coded, Coded(x))
        own = q_id[:, None] == ids[None, :]
        near[own] = -np.inf
        if at == 0 and len(ids) > k:
            low = near - off
            least = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        i, j = np.nonzero((near + off >= least[:, None]) & ~own)
        for lo in range(0, len(i), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            scores = dot(q[i[part]], x[j[part]])
            for a, s, b in zip(i[part].tolist(), scores.tolist(), ids[j[part]].tolist(), strict=True):
                heap = heaps[a]
                if len(heap) < k:
                    heapq.heappush(heap, (s, -b))
                elif (s, -b) > heap[0]:
                    heapq.heapreplace(heap, (s, -b))
        full = [a for a, h in enumerate(heaps) if len(h) == k]
        least[full] = np.maximum(least[full], [heaps[a][0][0] for a in full])
    return heaps


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k vectors of largest inner product, ties to the smaller id.

    ``is_query`` is a condition on the id, given as column ``id``. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows with a null id. Rows that repeat an id count once (the
    smallest vector in array order). Vectors meet only those of equal length. Fewer than k others: all of them.
    Empty tables and no queries give no rows.
    """
    ship(vectors.sparkSession)
    kind = "float" if vectors.select(vec_col).schema[0].dataType.simpleString() == "array<float>" else "double"
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    v = v.where("id is not null").where(usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))
    v = written(v.withColumn("dim", F.size("v")).withColumn("asks", is_query), "neighbours")
    total, asked = v.agg(F.count("*"), F.count_if("asks")).first()
    stripes, blocks = max(1, -(-total // STRIPE)), max(1, -(-asked // QUERY_BLOCK))
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = v.where("asks").select("id", "v", "dim", deal(blocks, 1).alias("block"), span(stripes).alias("stripe"))
    c = v.select("id", "v", "dim", span(blocks).alias("block"), deal(stripes, 2).alias("stripe"))

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        dim = left["dim"][0].as_py()
        q_id, c_id = left["id"].to_numpy(), right["id"].to_numpy()
        heaps = cell(q_id, matrix(left["v"], dim), c_id, matrix(right["v"], dim), k)
        n = [len(h) for h in heaps]
        return pa.table([pa.array(np.repeat(q_id, n)), pa.array([-b for h in heaps for _, b in h], pa.int64()),
                         pa.array([s for h in heaps for s, _ in h], pa.float64())], schema=_FOUND)

    keys = ["block", "stripe", "dim"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(product, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
