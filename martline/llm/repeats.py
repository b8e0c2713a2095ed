"""Suffix-array dedup: removal of repeated byte strings by column-wise Burrows-Wheeler construction.

A byte goes if it is covered by a string of ``length`` bytes that also starts earlier: in a document with a smaller id, or
in the same document before. Strings are judged on the input.

The collection is cut into pieces by anchors (``anchors``), so that equal strings meet under the same anchor:

1. Documents are put into blocks (sorted by id, compressed), written once. A block's pieces are named by anchor and
   content hash and sent to the buckets of their anchors; pieces of hot anchors (at most ``HOT``, from a sample of blocks) to the buckets
   of anchor and content.
2. A bucket finds the anchors that occur twice. Of pieces with equal content only the earliest can stay; it
   stays for certain if its anchor has no other content, which for hot anchors an aggregate tells. The others, with different contents
   under one anchor, are what the transform is built for.
3. Blocks send the text of those pieces. Tasks take whole anchors until they have a bundle, build the
   bundle's transform and common prefixes column by column (``bwt``), and read off which strings begin earlier elsewhere.
   Bundles are bounded, so the sequential files of the construction are sequential arrays of a task here (a folder of one
   machine must not be used on a cluster). An anchor with too many pieces for a bundle is done string by string
   with a grouped minimum, which splits over tasks.
4. Blocks with findings mark what is covered and give their documents back.

Nothing is dropped: every string of every text is in exactly one piece.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martline.llm import anchors, bwt
from martline.llm.common import at_work, discard, give_back, slices, small_batches, written

LENGTH, GRAM = 100, 40
#: Bytes of text in a block, of text behind a bucket of anchors, and of pieces in a bundle.
BLOCK, BUCKET, BUNDLE = 2 << 20, 64 << 20, 1 << 20
#: Pieces of one anchor beyond which it is done string by string.
MANY = 1 << 14
_NO_ID = (1 << 63) - 1

REMOVED, MIXED = 0, 1
#: Blocks that are looked at for hot anchors, and of which share of their pieces an anchor is hot (one of HOT).
SAMPLE, HOT = 16, 1000


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype=kind)


def _runs(a: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if not len(a):
        return []
    cut = np.flatnonzero(a[1:] != a[:-1]) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(a)], strict=True))


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _batch(ipc: bytes) -> pa.RecordBatch:
    t = pa.ipc.open_stream(pa.py_buffer(ipc)).read_all().combine_chunks()
    return t.to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], t.schema)


class Block:
    """Documents of a block (doc_id, data, ...), their pieces, and which pieces repeat an earlier one of the block."""

    def __init__(self, ipc: bytes, length: int, gram: int, name_all: bool = True) -> None:
        self.rows = _batch(ipc)
        data = self.rows.column(1)
        self.offsets = np.frombuffer(data.buffers()[1], np.int32)[: len(data) + 1].astype(np.int64)
        self.data = np.frombuffer(data.buffers()[2] or b"", np.uint8)[: self.offsets[-1]]
        self.anchor, self.start, self.windows = anchors.pieces(self.data, self.offsets[1:], length, gram)
        raw, h = self.data.tobytes(), xxhash.xxh64_intdigest
        order = np.argsort(self.anchor, kind="stable")
        same = self.anchor[order[1:]] == self.anchor[order[:-1]]
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(order) else same
        some = np.arange(len(order)) if name_all else order[twice]  # equal contents have equal anchors
        self.content = np.zeros(len(order), np.uint64)
        self.content[some] = [h(raw[s : s + n]) for s, n in zip(self.start[some].tolist(), (self.windows[some] + length - 1).tolist(), strict=True)]
        order = order[twice]
        order = order[np.lexsort((order, self.content[order], self.anchor[order]))]
        both = np.stack([self.anchor[order], self.content[order]])
        self.again = np.zeros(len(self.anchor), bool)
        self.again[order[1:][(both[:, 1:] == both[:, :-1]).all(axis=0)]] = True
        ids = self.rows.column(0).fill_null(_NO_ID).to_numpy()
        self.doc = np.searchsorted(self.offsets[1:], self.start, side="right")  # place of each piece's document
        self.doc_id = ids[self.doc] if len(ids) else np.zeros(0, np.int64)


def _begin() -> None:
    """Every task of this operator calls it, so that a worker drops what another operator left there."""
    at_work("repeats", anchors._powers.cache_clear)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a partition in blocks, each sorted by id."""
    _begin()
    number, held, size = TaskContext.get().partitionId() << 33, [], 0

    def close() -> pa.RecordBatch:
        nonlocal number, held, size
        t = pa.Table.from_batches(held).combine_chunks()
        order = np.argsort(t.column(0).combine_chunks().fill_null(_NO_ID).to_numpy(), kind="stable")
        b = t.take(pa.array(order)).combine_chunks().to_batches()[0]
        out = pa.record_batch([pa.array([number], pa.int64()), pa.array([_ipc(b)], pa.binary()), pa.array([size], pa.int64())],
                              names=["block", "ipc", "size"])
        number, held, size = number + 1, [], 0
        return out

    for batch in batches:
        for part in slices(batch, 1, BLOCK // 8):
            held.append(part)
            size += int(pc.sum(pc.binary_length(part.column(1))).as_py() or 0)
            if size >= BLOCK:
                yield close()
    if held:
        yield close()
    give_back()


def _frequent(length: int, gram: int):  # noqa: ANN202
    """(anchor, n) of the anchors of some blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            for ipc in batch.column(0):
                b = Block(ipc.as_py(), length, gram, name_all=False)
                anchor, n = np.unique(b.anchor[~b.again], return_counts=True)
                yield pa.record_batch([pa.array(anchor.view(np.int64)), pa.array(n)], names=["anchor", "n"])
        give_back()

    return run


def _hot(blocks: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchors with at least one of ``HOT`` of the pieces of ``SAMPLE`` blocks: at most ``HOT``. A sample does, as it only decides how
    pieces are dealt out."""
    chosen = [r.block for r in blocks.select("block").orderBy(F.xxhash64("block"), "block").limit(SAMPLE).collect()]  # numbers only: blobs stay where they are
    some = blocks.where(F.col("block").isin(chosen)).select("ipc").mapInArrow(_frequent(length, gram), "anchor long, n long")
    counts = written(some.groupBy("anchor").agg(F.sum("n").alias("n")), "repeats")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= F.lit(max(2, -(-total // HOT)))).select("anchor").collect()
    discard(blocks.sparkSession, counts)
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64))


def _name(buckets: int, length: int, gram: int, hot: np.ndarray):  # noqa: ANN202
    """Of each block: anchors, contents, documents and places of its different pieces, by bucket: of the anchor, of a hot one's pieces of
    anchor and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in batches:
            for block, ipc in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                b = Block(ipc.as_py(), length, gram)
                place = np.flatnonzero(~b.again)
                by = np.where(np.isin(b.anchor[place], hot), b.anchor[place] * np.uint64(0x9E3779B97F4A7C15) ^ b.content[place], b.anchor[place])
                bucket = (by >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                place, bucket = place[order], bucket[order]
                rows = []
                for lo, hi in _runs(bucket):
                    p = place[lo:hi]
                    rows.append((int(bucket[lo]), block, np.concatenate([b.anchor[p], b.content[p]]).tobytes(), _pack(b.doc_id[p]), _pack(p.astype(np.uint32))))
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                          names=["bucket", "block", "names", "docs", "places"])
        give_back()

    return run


def _hot_contents(hot: np.ndarray):  # noqa: ANN202
    """(anchor, low, high): the hot anchors of a partition with their least and greatest content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.iinfo(np.int64)
        low, high = np.full(len(hot), top.max), np.full(len(hot), top.min)
        for batch in batches:
            for names in batch.column(0).to_pylist():
                anchor, content = np.frombuffer(names, np.uint64).reshape(2, -1)
                at = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
                some = hot[at] == anchor
                np.minimum.at(low, at[some], content[some].view(np.int64))
                np.maximum.at(high, at[some], content[some].view(np.int64))
        seen = low <= high
        yield pa.record_batch([pa.array(hot[seen].view(np.int64)), pa.array(low[seen]), pa.array(high[seen])], names=["anchor", "low", "high"])

    return run


def _mixed(named: DataFrame, hot: np.ndarray) -> np.ndarray:
    """The hot anchors that have different contents: a minimum and a maximum each, so their pieces never meet."""
    spans = named.select("names").mapInArrow(_hot_contents(hot), "anchor long, low long, high long")
    found = spans.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("anchor").collect()  # at most HOT
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64))


def _decide(rows: list[tuple], hot: np.ndarray, mixed: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Of a bucket's rows (block, names, docs, places): what each block has to remove, and to send as mixed. Of hot anchors, whose
    pieces are in many buckets, ``mixed`` are those with different contents."""
    names = [np.frombuffer(r[1], np.uint64).reshape(2, -1) for r in rows]
    anchor, content = np.concatenate([n[0] for n in names]), np.concatenate([n[1] for n in names])
    _, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
    keep = (count[back] > 1) | np.isin(anchor, mixed)
    anchor, content = anchor[keep], content[keep]
    block = np.repeat(np.arange(len(rows)), [n.shape[1] for n in names])[keep]
    doc = np.concatenate([_unpack(r[2], "i8") for r in rows])[keep]
    place = np.concatenate([_unpack(r[3], "u4") for r in rows])[keep]
    if not len(anchor):
        return
    number = np.array([r[0] for r in rows])[block]
    order = np.lexsort((place, number, doc, content, anchor))
    a, c = anchor[order], content[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_piece = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    contents = np.bincount(np.cumsum(new_anchor) - 1, weights=new_piece)[np.cumsum(new_anchor) - 1]
    several = np.where(np.isin(a, hot), np.isin(a, mixed), contents > 1)
    for what, chosen in ((REMOVED, ~new_piece), (MIXED, new_piece & several)):
        at = order[chosen]
        at = at[np.argsort(block[at], kind="stable")]
        for lo, hi in _runs(block[at]):
            yield rows[block[at[lo]]][0], what, _pack(np.sort(place[at[lo:hi]]).astype(np.uint32))


def _buckets(hot: np.ndarray, mixed: np.ndarray):  # noqa: ANN202
    """Rows sorted by bucket, one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        now, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            got = list(_decide(held, hot, mixed)) if held else []
            if got:
                b, w, p = zip(*got, strict=True)
                yield pa.record_batch([pa.array(b, pa.int64()), pa.array(w, pa.int32()), pa.array(p, pa.binary())], names=["block", "what", "places"])

        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    yield from out()
                    now, held = bucket, []
                held.append(tuple(row))
        yield from out()
        held.clear()
        give_back()

    return run


def _cover(size: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes, -1)
    return np.cumsum(edge[:-1]) > 0


def _whole_letters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Without the bytes of letters (UTF-8) of which only a part would go."""
    letter = np.cumsum((data & 0xC0) != 0x80)
    stays = np.zeros(int(letter[-1]) + 1 if len(letter) else 1, bool)
    stays[letter[~gone]] = True
    return gone & ~stays[letter]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_RESULT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
           ("spans", _SPANS), ("kept", pa.binary())]
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,length:long>>, kept binary"
_STEP = [("kind", pa.int32()), ("block", pa.int64()), ("blob", pa.binary()), ("anchor", pa.int64()), ("piece", pa.binary()), ("place", pa.int32())]
STEP = "kind int, block long, blob binary, anchor long, piece binary, place int"
FINISHED, REST, PIECE = 0, 1, 2


def _results(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, gone: np.ndarray | None, which: np.ndarray, text: str) -> dict[str, pa.Array]:
    """Result columns of some documents of a block; ``gone`` marks the removed bytes."""
    out: dict[str, list] = {name: [] for name, _ in _RESULT[1:]}
    for d in which.tolist():
        lo, hi = int(offsets[d]), int(offsets[d + 1])
        g = np.zeros(hi - lo, bool) if gone is None else gone[lo:hi]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]]))).reshape(-1, 2).tolist()
        rest = data[lo:hi][~g].tobytes() if edge else data[lo:hi].tobytes()
        kept = data[lo:hi][~_whole_letters(data[lo:hi], g)].tobytes() if edge and text == "letters" else rest
        for name, value in (("n_bytes", hi - lo), ("n_removed", int(g.sum())), ("n_spans", len(edge)), ("kept_sha256", hashlib.sha256(rest).hexdigest()),
                            ("spans", [{"start": a, "length": b - a} for a, b in edge]), ("kept", None if text == "none" else kept)):
            out[name].append(value)
    cols = {"doc_id": rows.column(0).take(pa.array(which, pa.int64()))} | {n: pa.array(out[n], k) for n, k in _RESULT[1:]}
    return cols | ({"carried": rows.column(2).take(pa.array(which, pa.int64()))} if rows.num_columns > 2 else {})


def _table(schema: pa.Schema, cols: dict[str, pa.Array], n: int) -> pa.Table:
    return pa.table([cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)


def _second(left: pa.Table, right: pa.Table, length: int, gram: int, text: str, schema: pa.Schema) -> pa.Table:
    """A block and what the buckets say of it: finished documents, the rest of the block, and mixed pieces."""
    _begin()
    if not left.num_rows:
        return schema.empty_table()
    number = left["block"][0].as_py()
    b = Block(left["ipc"][0].as_py(), length, gram, name_all=False)
    gone, mixed = b.again.copy(), np.zeros(len(b.again), bool)
    for what, places in zip(right["what"].to_pylist(), right["places"].to_pylist(), strict=True):
        (gone if what == REMOVED else mixed)[_unpack(places, "u4")] = True
    docs = np.unique(b.doc[gone | mixed])
    free = np.setdiff1d(np.arange(b.rows.num_rows), docs)
    out = [_table(schema, {"kind": pa.array([FINISHED] * len(free))} | _results(b.rows, b.data, b.offsets, None, free, text), len(free))]
    if len(docs):
        sub = b.rows.take(pa.array(docs, pa.int64()))
        size = b.offsets[docs + 1] - b.offsets[docs]
        of = np.flatnonzero(gone | mixed)
        at = np.searchsorted(docs, b.doc[of])
        start = b.start[of] - b.offsets[b.doc[of]] + (np.cumsum(size) - size)[at]
        blob = pickle.dumps((_ipc(sub), _pack(start), _pack(b.windows[of]), _pack(gone[of]), _pack(of)))
        out.append(_table(schema, {"kind": pa.array([REST]), "block": pa.array([number]), "blob": pa.array([blob], pa.binary())}, 1))
        m = np.flatnonzero(mixed & ~gone)
        raw = b.data.tobytes()
        pieces = [raw[s : s + n] for s, n in zip(b.start[m].tolist(), (b.windows[m] + length - 1).tolist(), strict=True)]
        out.append(_table(schema, {"kind": pa.array([PIECE] * len(m), pa.int32()), "block": pa.array([number] * len(m), pa.int64()),
                                   "anchor": pa.array(b.anchor[m].view(np.int64)), "piece": pa.array(pieces, pa.binary()),
                                   "doc_id": pa.array(b.doc_id[m]), "place": pa.array(m.astype(np.int32))}, len(m)))
    return pa.concat_tables(out)


def _third(left: pa.Table, right: pa.Table, length: int, text: str, schema: pa.Schema) -> pa.Table:
    """The rest of a block and the masks of its mixed pieces: results of its documents."""
    _begin()
    if not left.num_rows:
        return schema.empty_table()
    ipc, start, windows, gone, place = pickle.loads(left["blob"][0].as_py())
    rows, start, windows, gone, place = _batch(ipc), _unpack(start, "i8"), _unpack(windows, "i8"), _unpack(gone, "?"), _unpack(place, "i8")
    offsets = np.frombuffer(rows.column(1).buffers()[1], np.int32)[: rows.num_rows + 1].astype(np.int64)
    data = np.frombuffer(rows.column(1).buffers()[2] or b"", np.uint8)[: offsets[-1]]
    at = np.searchsorted(place, right["place"].to_numpy())
    mask = right["mask"].to_numpy().view(np.uint64)
    bit = [np.flatnonzero(mask >> np.uint64(i) & np.uint64(1)) for i in range(64)]
    starts = np.concatenate([start[gone], *(start[at[x]] + i for i, x in enumerate(bit))])
    sizes = np.concatenate([windows[gone] + length - 1, np.full(len(starts) - int(gone.sum()), length)])
    every = np.arange(rows.num_rows)
    return _table(schema, _results(rows, data, offsets, _cover(len(data), starts, sizes), every, text), len(every))


def _bundle(length: int):  # noqa: ANN202
    """Masks of the pieces, whole anchors taken together up to a bundle's size; rows come sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        held: list[pa.RecordBatch] = []
        size = 0

        def work(t: pa.Table) -> pa.RecordBatch:
            text = t["piece"].combine_chunks()
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            rank = np.empty(len(text), np.int64)
            rank[np.lexsort((t["place"].to_numpy(), t["block"].to_numpy(), t["doc_id"].to_numpy()))] = np.arange(len(text))
            mask = bwt.later_windows(data, offsets[:-1] - offsets[0], np.diff(offsets), rank, length)
            some = np.flatnonzero(mask)
            return pa.record_batch([t["block"].combine_chunks().take(pa.array(some)), t["place"].combine_chunks().take(pa.array(some)), pa.array(mask[some].view(np.int64))],
                                   names=["block", "place", "mask"])

        for b in batches:
            held.append(b)
            size += b.column(1).nbytes
            if size >= BUNDLE:
                t = pa.Table.from_batches(held).combine_chunks()
                a = t["anchor"].to_numpy()
                cut = int(np.searchsorted(a, a[-1]))  # the last anchor may go on
                if cut:
                    yield work(t.slice(0, cut).combine_chunks())
                held = t.slice(cut).combine_chunks().to_batches()
                size = sum(x.column(1).nbytes for x in held)
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())
        held = []
        give_back()

    return run


def _strings(length: int):  # noqa: ANN202
    """Every string of the pieces by itself: two hashes and where it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = xxhash.xxh64_intdigest, xxhash.xxh3_64_intdigest
        signed = lambda x: np.array(x, np.uint64).view(np.int64)
        for b in batches:
            text = b.column(1).to_pylist()
            n = np.array([len(x) - length + 1 for x in text])
            strings = [x[i : i + length] for x in text for i in range(len(x) - length + 1)]
            row = pa.array(np.repeat(np.arange(len(text)), n))
            bit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.record_batch([pa.array(signed([one(x) for x in strings])), pa.array(signed([two(x) for x in strings])),
                                   *(b[c].take(row) for c in ("doc_id", "block", "place")), pa.array(bit.astype(np.int32))],
                                  names=["h1", "h2", "doc_id", "block", "place", "bit"])

    return run


def _masks(pieces: DataFrame, length: int) -> DataFrame:
    """(block, place, mask): bits of the strings of a mixed piece that begin earlier elsewhere."""
    many = written(pieces.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("anchor"), "repeats")
    few = pieces if many.isEmpty() else pieces.join(many, "anchor", "left_anti")
    out = (few.select("anchor", "piece", "doc_id", "block", "place").repartition("anchor").sortWithinPartitions("anchor")
           .mapInArrow(_bundle(length), "block long, place int, mask long"))
    if few is pieces:
        return out
    large = pieces.join(many, "anchor", "left_semi").select("anchor", "piece", "doc_id", "block", "place")
    first = (large.mapInArrow(_strings(length), "h1 long, h2 long, doc_id long, block long, place int, bit int")
             .groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "block", "place", "bit")).alias("s")).select("s.*"))
    stays = first.groupBy("block", "place").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("stays"))
    n = F.length("piece") - length + 1
    every = F.when(n == 64, F.lit(-1).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1)
    return out.unionByName(large.select("block", "place", every.alias("every")).join(stays, ["block", "place"], "left")
                           .select("block", "place", F.col("every").bitwiseAND(F.bitwise_not(F.coalesce("stays", F.lit(0).cast("long")))).alias("mask")))


def remove_repeats(df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "none", carry: list[str] | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept[, carried]), one row per input row.

    ``spans`` are the maximal removed runs (start, length in bytes); ``kept`` is what remains: null with text="none", the bytes
    with "bytes", and with "letters" the bytes and also the whole of every letter of which a part remains, so
    it is UTF-8. ``carried`` is a struct of the columns named by ``carry``. ``length`` less ``gram`` is at most 63.

    Null and empty texts and those under ``length`` bytes lose nothing. Rows with a null id come after all others. Rows that
    repeat an id are documents of their own, in the order of the table's files. An empty table gives no rows.
    """
    assert 0 < gram <= length <= gram + 63, "a piece has at most 64 windows"
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"),
                     *([F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []))
    carried = f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    result = pa.schema(_RESULT + ([("carried", to_arrow_schema(rows.schema).field("carried").type)] if carry else []))
    step = pa.schema([*pa.schema(_STEP), *result])
    blocks = written(rows.mapInArrow(_blocks, "block long, ipc binary, size long"), "repeats", group_rows=8)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    hot, mixed = _hot(blocks, length, gram), np.zeros(0, np.uint64)
    named = blocks.select("block", "ipc").mapInArrow(_name(buckets, length, gram, hot), "bucket int, block long, names binary, docs binary, places binary")
    if len(hot):
        named = written(named, "repeats")
        mixed = _mixed(named, hot)
    told = named.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_buckets(hot, mixed), "block long, what int, places binary")
    parts = written(blocks.select("block", "ipc").groupBy("block").cogroup(told.groupBy("block"))
                    .applyInArrow(lambda a, b: _second(a, b, length, gram, text, step), f"{STEP}, {RESULT}{carried}"), "repeats")
    discard(spark, blocks)
    if len(hot):
        discard(spark, named)
    masks = _masks(parts.where(F.col("kind") == PIECE).select("anchor", "piece", "doc_id", "block", "place"), length)
    rest = parts.where(F.col("kind") == REST).select("block", "blob")
    last = rest.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(lambda a, b: _third(a, b, length, text, result), RESULT + carried)
    return parts.where(F.col("kind") == FINISHED).select(*result.names).unionByName(last)
