"""SimHash near-dedup by bit-sliced comparison.

A text's fingerprint is the majority, bit by bit, of the XXH64 (seed 42) of its word shingles. Equal
fingerprints are brought together first. Different ones within ``radius`` bits agree in at least two of radius + 2
bit blocks, so each is put into one bucket for every pair of blocks (of three of radius + 3 blocks where there are very many,
``equal_blocks``). A bucket with more than ``CELL`` fingerprints
is cut into parts, and every two parts meet in a cell of their own, so no task gets a whole hot bucket.

Within a task the cells stand one after another as vertical bit planes: lane i of shift d is the pair (i, i + d).
The planes of a shift are XORed a few at a time and added into carry-save bit counters, for 64 pairs a word; words
whose pairs all exceed the radius (or cross a cell's border) are abandoned. Found pairs go into a union-find, and
a task emits one link per joined fingerprint, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import EDGES, at_work, components, edge_batch, meet, slices, small_batches, texts, texts_columns, written

#: Fingerprints of a bucket beyond which it is cut into parts.
CELL = 1024
#: Lanes compared together; a task's memory grows with this, not with its rows.
LANES = 1 << 16
#: Planes added between two looks at what can be abandoned.
STEP = 8

_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of every k-word shingle, repeats included; A-Z lower-cased; words end at ASCII white space."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(joined, 42)]
    starts, at = [0], 0
    for w in words:
        at += len(w) + 1
        starts.append(at)
    h = xxhash.xxh64_intdigest
    return [h(joined[a : b - 1], 42) for a, b in zip(starts, starts[k:], strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """Bits set in over half the hashes, as a signed 64-bit number; 0 without hashes."""
    if not hashes:
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every whole text; no words: 0. Narrow."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("simhash")
        for batch in batches:
            for part in slices(batch):
                fp = [fingerprint(shingle_hashes(x, shingle)) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(fp, pa.int64())], schema=_FP)

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _keys(fp: Column, radius: int, equal: int = 2) -> list[Column]:
    """Bucket keys: the bits of ``equal`` of radius + ``equal`` blocks and the number of the choice. Fingerprints within the radius
    agree in at least so many."""
    ends = [64 * i // (radius + equal) for i in range(radius + equal + 1)]
    block = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << b - a) - 1) for a, b in pairwise(ends)]

    def value(chosen: tuple[int, ...]) -> Column:
        out = block[chosen[0]]
        for i in chosen[1:]:
            out = F.shiftleft(out, 64 // (radius + equal) + 1).bitwiseOR(block[i])
        return out

    return [F.struct(F.lit(t).alias("t"), value(c).alias("v")) for t, c in enumerate(combinations(range(radius + equal), equal))]


def equal_blocks(n: int, radius: int) -> int:
    """In how many blocks close fingerprints are to agree: 2, or more where a bucket of ``n`` spread fingerprints would hold over 64 of
    them. One more block means more copies of each, but buckets smaller by its bits."""
    equal = 2
    while equal < 4 and n >> (64 * equal // (radius + equal)) > 64:
        equal += 1
    return equal


def planes(fp: np.ndarray) -> np.ndarray:
    """(64, words) uint64: bit b of lane i is bit i % 64 of word i // 64 of plane b; two words of zeros follow."""
    n = len(fp)
    bits = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    out = np.zeros((64, (n + 63) // 64 + 2), np.uint64)
    out.view(np.uint8)[:, : (n + 7) // 8] = np.packbits(bits.T, axis=1, bitorder="little")
    return out


def close_pairs(fp: np.ndarray, after: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) index arrays of lanes within ``radius`` bits; ``after[i]`` lanes behind i share its cell."""
    p = planes(fp)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    words = np.arange((len(fp) + 63) // 64)
    padded = np.zeros(len(words) * 64, after.dtype)
    padded[: len(after)] = after
    most = padded.reshape(-1, 64).max(axis=1)
    bits = max(1, radius.bit_length())
    for d in range(1, int(after.max(initial=0)) + 1):
        words = words[most[words] >= d]
        w, (q, r) = words, divmod(d, 64)
        dead = ~np.packbits((padded.reshape(-1, 64)[w] >= d), axis=1, bitorder="little").view(np.uint64).ravel()
        count = [np.zeros(len(w), np.uint64) for _ in range(bits)]
        for first in range(0, 64, STEP):
            part = slice(first, first + STEP)
            x = p[part, w + q] >> np.uint64(r)
            if r:
                x |= p[part, np.minimum(w + q + 1, p.shape[1] - 1)] << np.uint64(64 - r)
            x ^= p[part, w]
            for carry in x:
                for b in range(bits):
                    count[b], carry = count[b] ^ carry, count[b] & carry
                dead |= carry  # more than the counters hold
            over, same = np.zeros_like(dead), np.full_like(dead, ones)
            for b in reversed(range(bits)):
                if radius >> b & 1:
                    same &= count[b]
                else:
                    over |= same & count[b]
                    same &= ~count[b]
            dead |= over
            live = dead != ones
            if not live.all():
                w, dead, count = w[live], dead[live], [c[live] for c in count]
                if not len(w):
                    break
        if len(w):
            lane = np.unpackbits((~dead).view(np.uint8).reshape(len(w), 8), axis=1, bitorder="little")
            row, col = np.nonzero(lane)
            i = w[row] * 64 + col
            yield i, i + d


def _compare(ids: np.ndarray, fp: np.ndarray, cell: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (id, id) that span the groups of close lanes; ``cell`` numbers the cells in order."""
    n = len(fp)
    last = np.append(np.flatnonzero(cell[1:] != cell[:-1]), n - 1)
    after = last[np.searchsorted(last, np.arange(n))] - np.arange(n)
    root = np.arange(n)
    for i, j in close_pairs(fp, after, radius):
        while True:  # flat roots let most pairs be passed over at once
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        new = root[i] != root[j]
        for a, b in zip(i[new].tolist(), j[new].tolist(), strict=True):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
    joined = np.flatnonzero(root != np.arange(n))
    return list(zip(ids[joined].tolist(), ids[root[joined]].tolist(), strict=True))


def links(fps: DataFrame, radius: int = 4, equal: int | None = None) -> DataFrame:
    """(src, dst) links over (fp, rep), distinct fingerprints, that connect all that are within ``radius`` bits. ``equal``: see
    ``equal_blocks``, by default from their number."""
    equal = equal_blocks(fps.count(), radius) if equal is None else equal
    keyed = fps.select("fp", "rep", F.explode(F.array(*_keys(F.col("fp"), radius, equal))).alias("k")).select("fp", "rep", "k.t", "k.v")
    rows = meet(keyed, ["t", "v"], "fp", CELL, "simhash").select("fp", "rep", "t", "v", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # columns fp, rep, t, v, cell
        rows = 0

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            if not rows:
                return
            a = np.concatenate(held, axis=1)
            change = np.flatnonzero((a[2:, 1:] != a[2:, :-1]).any(axis=0)) + 1
            cut = a.shape[1] if final else (int(change[-1]) if len(change) else 0)  # the last cell may go on
            if cut:
                number = np.zeros(cut, np.int64)
                number[change[change < cut]] = 1
                yield edge_batch(_compare(a[1, :cut], a[0, :cut], np.cumsum(number), radius))
            held, rows = [a[:, cut:]], a.shape[1] - cut

        for b in batches:
            held.append(np.stack([np.asarray(c, dtype=np.int64) for c in b.columns]))
            rows += b.num_rows
            if rows >= LANES:
                yield from flush(False)
        yield from flush(True)

    return rows.mapInArrow(run, EDGES)


def near_duplicates(df: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``fingerprint`` is 16 hex digits; ``component_id`` is the smallest id reachable over links of at most ``radius``
    differing bits, the row's own included. Null and empty texts have fingerprint zero, which links like any other.
    Rows that repeat an id are one document with several fingerprints, which are thereby linked. A null id is
    never a component's id: its row gets the component of its fingerprint, null if no row with an id is there.
    """
    fp = written(fingerprints(df, shingle, id_col, text_col), "simhash")
    reps = written(fp.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash")
    shared = fp.where("doc_id is not null").join(reps.where("rep is not null"), "fp").where("doc_id <> rep")
    # an id with several fingerprints links them: only such ids matter here
    twice = fp.groupBy("doc_id").agg(F.countDistinct("fp").alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    own = shared.join(twice, "doc_id").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))
    found = components(links(reps.where("rep is not null"), radius).unionByName(own))
    named = reps.join(found, reps["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return (fp.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def _numbered(shingle: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("simhash")
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                fp = [fingerprint(shingle_hashes(x, shingle)) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(fp, pa.int64()), pa.array(np.arange(row, row + len(fp))), part.column(2)],
                                      names=["doc_id", "fp", "row", "carried"])
                row += len(fp)

    return run


def one_of_each(df: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df``, one of each group of rows whose fingerprints are linked: the one with the smallest id (null last); of several
    with that id the one whose text has the smallest hash.

    Rows count, not ids: different texts that share an id, or have none, are judged each by itself. Rows are numbered as they are
    written with their fingerprints; only numbers, ids and fingerprints are grouped."""
    small_batches(df.sparkSession)
    rows = df.select(*texts_columns(id_col, text_col), F.struct(*[F.col(c) for c in df.columns]).alias("carried"))
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc_id", "fp", "row")), rows.schema["carried"]])
    at = written(rows.mapInArrow(_numbered(shingle), schema), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(F.col(f"carried.{text_col}")).alias("hash"), "row")
    first = written(at.select("fp", order.alias("first")).groupBy("fp").agg(F.min("first").alias("first")), "simhash")
    found = components(links(first.select("fp", F.col("fp").alias("rep")), radius))
    stays = first.join(found, first["fp"] == found["node"], "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    stays = written(stays.select(F.col("first.row").alias("row")), "simhash")
    return at.join(stays.hint("merge"), "row", "left_semi").select(*[F.col("carried").getField(c).alias(c) for c in df.columns])
