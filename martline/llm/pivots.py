"""Embedding near-dedup by a pivot-permutation index.

Every vector is described by its ``NEAREST`` nearest pivots (reference points picked far apart from a bounded sample of
the vectors). The inverted lists are kept by label and pair of pivots, so two vectors meet in a list exactly if they
share two pivots or more; a list too large for a task is cut into cells (``common.meet``). Vectors that meet are
verified by cosine in double precision. A pair is counted only in the list of its two smallest shared pivots, and a
task emits numbers of links and one link per joined vector, not the pairs.

Equal vectors of a label are one entry with a multiplicity. The index covers every row. Its recall is that
of sharing two of eight pivots, which at cosine 0.98 was 1.0000 for 64 to 4096 pivots (20,000 random pairs in 64 dimensions each);
pairs reported are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import components, meet, ship, written
from martline.llm.neighbours import matrix, usable

#: Pivots that describe a vector, and how many pivots there are: the root of the number of vectors within these.
NEAREST, FEWEST, MOST = 8, 64, 4096
#: Vectors that pivots are picked from, at most.
SAMPLE = 8192
#: Entries of an inverted list beyond which it is cut into cells.
CELL = 1024
#: Cells up to this size are compared by shifts, many at once; larger ones by a matrix product.
SMALL = 16
#: Rows taken together in a task.
ROWS = 1 << 14

_OUT = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """n rows of unit vectors, each the farthest from those picked before (the first row first)."""
    picked, best = [0], x @ x[0]
    while len(picked) < min(n, len(x)):
        picked.append(int(best.argmin()))
        best = np.maximum(best, x @ x[picked[-1]])
    return x[picked]


def pairs_within(cell: np.ndarray, size: np.ndarray, x: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), i < j, of the same cell with cosine of at least ``least``; ``cell`` ascends, ``size`` is per row."""
    n = len(cell)
    last = np.append(np.flatnonzero(cell[1:] != cell[:-1]), n - 1)
    after = last[np.searchsorted(last, np.arange(n))] - np.arange(n)
    small = size <= SMALL
    for d in range(1, SMALL):
        i = np.flatnonzero(small & (after >= d))
        if not len(i):
            break
        hit = np.einsum("ij,ij->i", x[i], x[i + d]) >= least
        yield i[hit], i[hit] + d
    first = np.append(0, last[:-1] + 1)
    for lo, hi in zip(first.tolist(), (last + 1).tolist(), strict=True):
        if hi - lo > SMALL:
            for at in range(lo, hi, 512):
                i, j = np.nonzero(x[at : min(at + 512, hi)] @ x[at:hi].T >= least)
                up = j > i
                yield i[up] + at, j[up] + at


def roots(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smaller and smaller common labels of the pairs, until nothing changes."""
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _verify(t: pa.Table, least: float) -> pa.RecordBatch:
    """Numbers of links (other null) and joining links (n = 0) of whole cells."""
    dim = len(t["v"][0]) if t.num_rows else 1
    ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
    key = np.stack([t[c].to_numpy().astype(np.int64) for c in ("label", "a", "b", "cell")])
    change = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
    cell = np.cumsum(change)
    size = np.bincount(cell)[cell]
    x = unit(matrix(t["v"], dim))
    near = np.frombuffer(b"".join(t["near"].to_pylist()), np.int16).reshape(len(ids), -1)
    part = t["part"].to_numpy()
    # in a cell of two parts only pairs across are new
    parts_min, parts_max = np.full(cell.max() + 1, 1 << 30), np.full(cell.max() + 1, -1)
    np.minimum.at(parts_min, cell, part)
    np.maximum.at(parts_max, cell, part)
    two = (parts_min != parts_max)[cell]
    pivots = key[1:3].T
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for i, j in pairs_within(cell, size, x, least):
        keep = ~two[i] | (part[i] != part[j])
        i, j = i[keep], j[keep]
        for lo in range(0, len(i), 1 << 17):
            a, b = i[lo : lo + (1 << 17)], j[lo : lo + (1 << 17)]
            shared = (near[a][:, :, None] == near[b][:, None, :]).any(axis=2)  # near ascends
            order = np.cumsum(shared, axis=1)
            first = near[a, (order == 1).argmax(axis=1)]
            second = near[a, (order == 2).argmax(axis=1)]
            own = (first == pivots[a, 0]) & (second == pivots[a, 1])
            a, b = a[own], b[own]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = roots(len(ids), a, b, root)
    got, joined = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(ids)))
    none = np.zeros(len(got), np.int64)
    return pa.record_batch([pa.array(np.concatenate([ids[got], ids[joined]])),
                            pa.array(np.concatenate([none, ids[root[joined]]]), mask=np.arange(len(got) + len(joined)) < len(got)),
                            pa.array(np.concatenate([links[got], np.zeros(len(joined), np.int64)]))], schema=_OUT)


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per id.

    Vectors are compared when their labels are equal and not null and their lengths agree. Null, empty and zero vectors and
    those with a null or non-finite component link with nothing (n_links 0, themselves the component). Rows that repeat
    an id count once: the smallest (label, vector) in order. Rows with a null id are one row of nulls
    with n_links 0. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = "float" if vectors.select(vec_col).schema[0].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("long").alias("label"),
                                                                          F.col(vec_col).cast(f"array<{kind}>").alias("v")).alias("r"))
    rows = rows.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")
    rows = written(rows.withColumn("joins", F.coalesce(usable(F.col("v")), F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull()), "pivots")
    kinds = written(rows.where("joins").groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                    .withColumn("dim", F.size("v")), "pivots")
    listed = None
    for dim, n in kinds.groupBy("dim").count().orderBy("dim").collect():  # one index for each length of vectors
        pivots = _pivots(kinds.where(F.col("dim") == dim), dim, n)
        more = kinds.where(F.col("dim") == dim).drop("dim").mapInArrow(_lister(pivots, kind), f"id long, label long, copies long, v array<{kind}>, near binary, a short, b short")
        listed = more if listed is None else listed.unionByName(more)
    one = rows.select("id", "label", "v", "joins")
    if listed is None:
        found = spark.createDataFrame([], "id long, other long, n long")
    else:
        found = written(meet(listed.withColumn("dim", F.size("v")), ["dim", "label", "a", "b"], "id", CELL, "pivots").mapInArrow(_checker(least), "id long, other long, n long"), "pivots")
    links = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.where("other is not null").select("id", "other")).withColumnRenamed("node", "id")
    told = kinds.join(links, "id", "left").join(joined, "id", "left").select(
        F.col("label").alias("l"), F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "id").alias("component"))
    out = one.where("joins").join(told, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")))
    out = out.select("id", "n", "component").unionByName(
        one.where("not joins").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component")))
    return out.select(F.col("id").alias("vec_id"), F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def _pivots(kinds: DataFrame, dim: int, n: int) -> np.ndarray:
    """Pivots from at most SAMPLE vectors (those with the smallest hashes of their ids)."""
    count = min(MOST, max(FEWEST, 1 << math.ceil(math.log2(max(1, n)) / 2)))
    sample = kinds.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(max(count, min(SAMPLE, 4 * count)))
    t = sample.toArrow()
    return spread(unit(matrix(t["v"], dim)), count)


def _lister(pivots: np.ndarray, kind: str):  # noqa: ANN202
    v = pa.list_(pa.float32() if kind == "float" else pa.float64())
    keep = min(NEAREST, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                x = unit(matrix(b["v"], pivots.shape[1]))
                near = np.sort(np.argpartition(-(x @ pivots.T), keep - 1, axis=1)[:, :keep], axis=1).astype(np.int16)
                pairs = list(combinations(range(keep), 2)) or [(0, 0)]
                n = b.num_rows
                row = pa.array(np.tile(np.arange(n), len(pairs)))
                named = pa.array([x.tobytes() for x in near], pa.binary())
                yield pa.record_batch([b["id"].take(row), b["label"].take(row), b["copies"].take(row), b["v"].cast(v).take(row), named.take(row),
                                       pa.array(np.concatenate([near[:, i] for i, _ in pairs])),
                                       pa.array(np.concatenate([near[:, j] for _, j in pairs]))], names=["id", "label", "copies", "v", "near", "a", "b"])

    return run


def _checker(least: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def whole(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            t = held.combine_chunks()
            key = np.stack([t[c].to_numpy().astype(np.int64) for c in ("dim", "label", "a", "b", "cell")])
            ends = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            cut = t.num_rows if final else (int(ends[-1]) if len(ends) else 0)
            dims = np.append(np.append(0, np.flatnonzero(key[0, 1:cut] != key[0, : max(cut - 1, 0)]) + 1), cut)
            for lo, hi in zip(dims[:-1].tolist(), dims[1:].tolist(), strict=True):
                if hi > lo:
                    yield _verify(t.slice(lo, hi - lo), least)
            held = t.slice(cut)

        for b in batches:
            held = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
            if held.num_rows >= ROWS:
                yield from whole(False)
        if held is not None and held.num_rows:
            yield from whole(True)

    return run
