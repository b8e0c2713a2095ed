"""Ranked lexical search by NRA over an index of impact-sorted lists.

Terms are the runs of letters (any beyond ASCII) and digits of a whole text, with A-Z in lower case. ``build`` cuts the documents into
segments and writes them: one row per segment with its terms and, for each of them, a list of (document, impact) by falling
impact. An impact is what the term gives to the document's score before the term's weight, so lists are sorted once for all items.

``search`` takes the items in blocks. A block's terms are weighed by their document counts over the whole index, and every
segment answers every item of the block by NRA (no random access): all lists are read in step down to a falling threshold; what was
read of a document is its lower bound, and with each list's last impact for the terms that it was not yet met in, its upper bound.
Documents that can't reach the k-th best score go. Reading ends when no unmet document could get in or tie, and the bounds of all that
are left have met; so membership, ties and scores are exact. A task takes the k best of a segment along to
its next segments as a threshold to begin with, and passes segments whose lists can't reach it. The k best of all
tasks are merged by windows, in two levels.

All numbers but the logarithm in a term's weight are integers.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import at_work, give_back, slices, small_batches, texts, written

#: Bytes of text in a segment, and of a long text that are cut into terms at once.
SEGMENT, CHUNK = 4 << 20, 1 << 20
#: Pairs of item and term in a block of items (one item alone may have more).
BLOCK_TERMS = 200_000
#: Parts into which the tasks' results for an item are dealt before its last merge.
PARTS = 64

# Letters, digits and all bytes of other letters stay, A-Z become a-z, the rest are spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(raw: bytes) -> Counter:
    """How often each term (UTF-8) occurs in a text."""
    folded = raw.translate(_FOLD)
    if len(folded) <= CHUNK:
        return Counter(folded.split())
    out, at = Counter(), 0
    while at < len(folded):
        end = at + CHUNK
        if end < len(folded):
            end = folded.rfind(b" ", at, end)
            if end < 0:  # a term longer than a chunk
                end = folded.find(b" ", at)
            end = len(folded) if end < 0 else end + 1
        out.update(folded[at:end].split())
        at = end
    return out


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype=kind)


SEGMENTS = "ids array<long>, n_docs long, n_terms long, sizes binary, terms binary, starts binary, docs binary, counts binary"
_SEGMENTS = pa.schema([("ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
                       *((c, pa.binary()) for c in ("sizes", "terms", "starts", "docs", "counts"))])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's documents that have terms, in segments."""
    at_work("lexical")

    def close() -> pa.RecordBatch:
        sizes = np.array([len(t) for t in terms])
        term = np.concatenate([np.array(t, np.int32) for t in terms])
        order = np.argsort(term, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(number)))])
        docs = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[order]
        count = np.concatenate([np.array(c, np.int32) for c in counts])[order]
        row = (ids, len(ids), int(count.sum()), _pack(np.array(lengths, np.int64)), zstandard.compress(b" ".join(number), 1),
               _pack(starts.astype(np.int64)), _pack(docs), _pack(count))
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _SEGMENTS, strict=True)], schema=_SEGMENTS)

    def begin() -> tuple:
        new: defaultdict = defaultdict()
        new.default_factory = new.__len__
        return new, [], [], [], [], 0

    number, ids, lengths, terms, counts, size = begin()
    for batch in batches:
        for part in slices(batch, 1, SEGMENT // 4):
            for doc_id, raw in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found = term_counts(raw)
                size += len(raw)
                if found:
                    ids.append(doc_id)
                    counts.append(list(found.values()))
                    lengths.append(sum(counts[-1]))
                    terms.append([number[t] for t in found])
            if size >= SEGMENT and ids:
                yield close()
                number, ids, lengths, terms, counts, size = begin()
    if ids:
        yield close()
    give_back()


LISTS = "ids array<long>, terms binary, starts binary, docs binary, impacts binary"
_LISTS = pa.schema([("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("terms", "starts", "docs", "impacts"))])


def impact(count: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What ``count`` occurrences in a document of ``length`` terms give, before the term's weight; lengths may be any size."""
    different, back = np.unique(length, return_inverse=True)
    norm = np.array([100 - 90 + 90 * n * documents // terms for n in different.tolist()], np.int64)[back]
    count = count.astype(np.int64)
    return 1_000_000_000 * count // (1000 * count + 8 * norm)


def _sorted_lists(documents: int, terms: int):  # noqa: ANN202
    """Segments with each term's list by falling impact, equal ones by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c, kind: _unpack(batch.column(c)[r].as_py(), kind)  # noqa: B023, E731
                starts, docs = get("starts", "i8"), get("docs", "i4")
                value = impact(get("counts", "i4"), get("sizes", "i8")[docs], documents, terms)
                order = np.lexsort((docs, -value, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
                yield pa.record_batch([batch.column("ids").slice(r, 1), batch.column("terms").slice(r, 1), batch.column("starts").slice(r, 1),
                                       pa.array([_pack(docs[order])], pa.binary()), pa.array([_pack(value[order].astype(np.int32))], pa.binary())], schema=_LISTS)

    return run


@dataclass
class Index:
    """Written segments, and how many documents with terms and how many terms (with repeats) they hold."""

    segments: DataFrame
    documents: int
    terms: int


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index of a table of texts. Every row is a document; those without terms (null, empty) can't be found and are left out."""
    small_batches(docs.sparkSession)
    cut = written(texts(docs, id_col, text_col).mapInArrow(_segments, SEGMENTS), "lexical")
    documents, terms = cut.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    lists = cut.select("ids", "sizes", "terms", "starts", "docs", "counts").mapInArrow(_sorted_lists(documents, terms), LISTS)
    return Index(written(lists, "lexical"), documents, terms)


def nra(docs: list[np.ndarray], impacts: list[np.ndarray], k: int, floor: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): every document whose score is above 0, at least ``floor`` and among the k best of these lists, ties at
    the last place included, and maybe some more. ``impacts`` (weighted) fall along each list."""
    frontier = np.array([x[0] for x in impacts], np.int64)  # bounds what is unread of each list
    falling = [-x for x in impacts]
    at, lower = np.zeros(len(docs), np.int64), np.zeros(n_docs, np.int64)
    alive, closed = np.ones(n_docs, bool), False  # closed: no document that was not met yet could get in
    met_doc, met_list = np.zeros(0, np.int32), np.zeros(0, np.int64)
    theta = int(frontier.max())
    while True:
        theta = max(1, theta // 2)
        new_doc, new_list = [met_doc], [met_list]
        for i in np.flatnonzero(frontier >= theta).tolist():
            lo, hi = int(at[i]), int(np.searchsorted(falling[i], -theta, side="right"))  # down to theta, itself included
            d, x = docs[i][lo:hi], impacts[i][lo:hi]
            at[i], frontier[i] = hi, theta - 1 if hi < len(docs[i]) else 0
            if closed:
                d, x = d[alive[d]], x[alive[d]]
            lower[d] += x  # a document is in a list once
            new_doc.append(d)
            new_list.append(np.full(len(d), i))
        met_doc, met_list = np.concatenate(new_doc), np.concatenate(new_list)
        if closed:  # forget what was read of documents that are out
            some = alive[met_doc]
            met_doc, met_list = met_doc[some], met_list[some]
        rest = int(frontier.sum())
        upper = lower + rest
        np.subtract.at(upper, met_doc, frontier[met_list])
        least = max(floor, 1)
        if n_docs > k:
            least = max(least, int(np.partition(lower, n_docs - k)[n_docs - k]))
        closed = closed or rest < least
        alive &= (upper >= least) & ((lower > 0) | (not closed))
        if closed and (upper == lower)[alive].all():
            found = np.flatnonzero(alive)
            return found, lower[found]


def _answer(items: list[np.ndarray], weights: np.ndarray, query_terms: list[bytes], k: int):  # noqa: ANN202
    """(item, score, doc_id): the k best documents of a partition's segments for each item.

    ``items`` hold places in ``query_terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("lexical")
        wanted = pa.array(query_terms, pa.binary())
        flat, first = np.concatenate(items), np.cumsum([0, *(len(x) for x in items[:-1])])
        best: list[list[tuple]] = [[] for _ in items]  # (-score, id is null, id)
        floor = np.zeros(len(items), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("ids")[r].as_py()
                own = pa.array(zstandard.decompress(batch.column("terms")[r].as_py()).split(b" "), pa.binary())
                place = pc.index_in(wanted, value_set=own)
                here = place.is_valid().to_numpy(zero_copy_only=False)
                place = place.fill_null(0).to_numpy()
                starts, docs = _unpack(batch.column("starts")[r].as_py(), "i8"), _unpack(batch.column("docs")[r].as_py(), "i4")
                impacts = _unpack(batch.column("impacts")[r].as_py(), "i4")
                most = np.where(here, weights * impacts[starts[place]], 0)
                bound = np.add.reduceat(most[flat], first)
                for i in np.flatnonzero((bound >= floor) & (bound > 0)).tolist():
                    t = items[i][most[items[i]] > 0]
                    spans = [(slice(starts[p], starts[p + 1]), w) for p, w in zip(place[t], weights[t].tolist(), strict=True)]
                    found, score = nra([docs[s] for s, _ in spans], [impacts[s].astype(np.int64) * w for s, w in spans], k, int(floor[i]), len(ids))
                    if len(found):
                        new = [(-s, ids[d] is None, ids[d] or 0) for d, s in zip(found.tolist(), score.tolist(), strict=True)]
                        best[i] = sorted(best[i] + new)[:k]
                        floor[i] = -best[i][-1][0] if len(best[i]) == k else 0
        rows = [(i, -s, None if null else d) for i, b in enumerate(best) for s, null, d in b]
        for at in range(0, len(rows), 10_000):
            cols = zip(*rows[at : at + 10_000], strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["item", "score", "doc_id"])
        give_back()

    return run


def _document_counts(query_terms: list[bytes]):  # noqa: ANN202
    """(term, df): in how many documents of a partition each query term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, df = pa.array(query_terms, pa.binary()), np.zeros(len(query_terms), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = pc.index_in(wanted, value_set=pa.array(zstandard.decompress(terms).split(b" "), pa.binary()))
                here = place.is_valid().to_numpy(zero_copy_only=False)
                df += np.where(here, np.diff(_unpack(starts, "i8"))[place.fill_null(0).to_numpy()], 0)
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            terms = [sorted(term_counts(x)) for x in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([part.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents with the highest scores above 0, equal scores by ascending doc_id
    (null last). A term counts once for an item. Rows that repeat an item_id (also null) are one item with the terms of all; items
    without terms that occur in the index get no rows, nor does any item of an empty index. Documents that repeat an id are
    ranked as documents of their own."""
    spark = items.sparkSession
    small_batches(spark)
    split = (texts(items, id_col, text_col).withColumnRenamed("doc_id", "item_id").mapInArrow(_item_terms, "item_id long, terms array<binary>")
             .select("item_id", F.explode("terms").alias("t")).groupBy("item_id").agg(F.sort_array(F.collect_set("t")).alias("terms")))
    split = written(split, "lexical")
    blocks = max(1, -(-(split.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    out = None
    for b in range(blocks):
        rows = split.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").collect()  # bounded by the block
        terms = sorted({bytes(t) for r in rows for t in r.terms})
        if not terms or not index.documents:
            continue
        df = {r.term: r.df for r in index.segments.select("terms", "starts").mapInArrow(_document_counts(terms), "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = np.array([weight(index.documents, df[i]) if i in df else 0 for i in range(len(terms))], np.int64)
        number = {t: i for i, t in enumerate(terms)}
        places = [np.array([number[bytes(t)] for t in r.terms], np.int64) for r in rows]
        found = index.segments.mapInArrow(_answer(places, weights, terms, k), "item int, score long, doc_id long")
        order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        for by in (["item", "part"], ["item"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # as bounded as the block
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
