"""Packing of documents into token windows: best-fit decreasing over a segment tree of remaining capacities.

A document's ids (with a separator at its end) are first cut into full windows; what is left of it, shorter than
a window, is a remainder. A task collects remainders up to a fixed number, takes them in decreasing
length and puts each into the tightest open window, found in a segment tree indexed by remaining
capacity. Cuts are free, so gaps that stay are then closed: the emptiest windows are dissolved and their pieces cut
to fill the others. The one window that is left is split at powers of two, which need no padding.

Every task packs its own rows, so nothing is shuffled and a lost task is packed anew in the same way; the
result depends on how the input is split, but holds each id in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from martline.llm.bpe import KEEP_WORDS, word_bpe
from martline.llm.common import slices, small_batches, texts

#: Remainders packed together; bounds a task's memory (each holds under ``window`` ids of four bytes).
BUNDLE = 20_000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


class Capacities:
    """Open windows by remaining capacity 1..size; a segment tree over the capacities finds the least one that
    is at least some length and has a window."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest window that holds ``length``."""
        i = length + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up until a right neighbour has a window
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, start in item, length) for items of 1..window-1 ids; every id once.

    All windows are full but the last few, which are as long as distinct powers of two."""
    tree, bins, room = Capacities(window), [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[k]
        if got := tree.take(n):
            left, b = got
        else:
            left, b = window, len(bins)
            bins.append([])
        bins[b].append((k, 0, n))
        if left - n:
            tree.add(left - n, b)
    room = [window - sum(p[2] for p in b) for b in bins]
    order = sorted((b for b in range(len(bins)) if room[b]), key=lambda b: (room[b], b))  # fullest first
    lo, hi = 0, len(order) - 1
    while lo < hi:
        b, donor = order[lo], bins[order[hi]]
        while room[b] and donor:
            k, start, n = donor.pop()
            part = min(n, room[b])
            bins[b].append((k, start, part))
            room[b] -= part
            if part < n:
                donor.append((k, start + part, n - part))
        lo += not room[b]
        hi -= not donor
    full = [b for b, r in zip(bins, room, strict=True) if b and not r]
    last = [p for p in bins[order[hi]]] if order and lo == hi and room[order[hi]] else []
    total = sum(p[2] for p in last)
    for bit in reversed(range(total.bit_length())):
        need, seq = total & 1 << bit, []
        while need:
            k, start, n = last.pop()
            part = min(n, need)
            seq.append((k, start, part))
            need -= part
            if part < n:
                last.append((k, start + part, n - part))
        if seq:
            full.append(seq)
    return full


def pack(df: DataFrame, tokenizer: str, window: int = 2048, separator: int = 1, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = True, keep_words: int = KEEP_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the piece's ids
    (little-endian uint32; null without ``with_ids``).

    Null text is the empty text (only the separator); rows that repeat are packed each; a null id stays null;
    an empty table gives no rows. Sequence ids are unique, not dense: the task's number times 2^33 and a count.
    ``keep_words`` bounds what a worker remembers of encoded words."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = word_bpe(tokenizer, keep_words), np.array([separator], dtype="<u4")
        seq = TaskContext.get().partitionId() << 33
        rest: list[tuple[int | None, int, int, np.ndarray]] = []  # doc, start, doc_tokens, ids
        out: list[tuple] = []

        def piece(doc, start: int, ids: np.ndarray, total: int, at: int) -> None:  # noqa: ANN001
            raw = ids.tobytes()
            out.append((doc, start, len(ids), zlib.crc32(raw), total, seq, at, raw if with_ids else None))

        def emit() -> pa.RecordBatch:
            got = pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)
            out.clear()
            return got

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal seq
            for pieces in best_fit([len(r[3]) for r in rest], window):
                at = 0
                for k, start, n in pieces:
                    doc, first, total, ids = rest[k]
                    piece(doc, first + start, ids[start : start + n], total, at)
                    at += n
                seq += 1
                if len(out) >= 2000:
                    yield emit()
            rest.clear()
            if out:
                yield emit()

        for batch in batches:
            for part in slices(batch):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([bpe.encode(text), end])
                    whole = len(ids) // window * window
                    for start in range(0, whole, window):
                        piece(doc, start, ids[start : start + window], len(ids), 0)
                        seq += 1
                    if whole < len(ids):
                        rest.append((doc, whole, len(ids), ids[whole:].copy()))
                if out:
                    yield emit()
                if len(rest) >= BUNDLE:
                    yield from flush()
        yield from flush()

    return texts(df, id_col, text_col).mapInArrow(run, PIECES)
