"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are fitted: of the target (a bounded sample of documents labelled good) and of raw
text (all documents, labelled or not). A document's log weight is the sum, over its
n-grams, of the log ratio of the two. Documents are then drawn without replacement in proportion to their weights: the top
k of log weight / temperature plus Gumbel noise, which is a hash of the document's id, so the draw can be repeated.

The n-grams are hashed words and starts of words, each once a document (so a word that one bad document repeats a
thousand times says little against others), and triples of word shapes: letters, digits, each kind of punctuation, and
whether a word repeats one of the two before it. Shapes count by their mean, as if every document had ``SHAPES_COUNT``.
Texts that are equal are counted once.

Every ratio counts, above 1 and below, smoothed by how sure it is: a word or start is as frequent in the target as in raw
text, or (``DIFFERENT`` of them, before anything is seen) has a ratio of its own with a gamma prior of ``OWN`` pseudo-counts at one.
The log ratio is taken times the probability of the second given the counts. So chance deviations of the many words of a long
clean text add up to little, and a word that 20 of 300 texts have and no good one counts in full. Ratios of shapes are posterior
means with ``PRIOR`` pseudo-counts. The mean over the target is taken off each kind's log ratios, which normalises for length: a
typical text of the target has weight 1 whether it is long, short or empty.

How many to draw: ``keep`` documents, or by default as many as have a weight above the cut that best tells good
from rejected labelled documents that were left out of the target: a quarter of the good ones and all rejected ones. Labels are a bounded sample (``MAX_LABELS``, smallest
hashes of ids), so that they can be broadcast; every document is counted, scored and takes part in the draw.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import Recent, at_work, give_back, slices, small_batches, texts, texts_columns, written

MAX_LABELS = 100_000
WORDS, STARTS, SHAPES = 1 << 19, 1 << 17, 1 << 15
SIZE = WORDS + STARTS + SHAPES
#: Letters of a word's start, pseudo-counts of shapes, how many shapes the mean stands for.
START, PRIOR, SHAPES_COUNT = 5, 5.0, 100.0
#: Share of words with a ratio of their own, and its pseudo-counts.
DIFFERENT, OWN = 0.001, 0.5
#: Runs of text whose tokens a worker keeps, at most about twice as many.
KEEP_RUNS = 200_000
_TOKEN = regex.compile(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]+")


def _tokens(run: str) -> bytes:
    """(hash, hash of the start, shape) of the tokens of a run of text without white space."""
    out = []
    for t in _TOKEN.findall(run):
        raw = t.encode("utf-8", "replace")
        shape = 1 if t[0].isalpha() else 2 if t[0].isnumeric() else 3 + zlib.crc32(raw[:2]) % 12
        out += [zlib.crc32(raw), zlib.crc32(t[:START].encode("utf-8", "replace")), shape]
    return array("I", out).tobytes()


_RUNS = Recent(_tokens, KEEP_RUNS)


def _forget() -> None:
    _RUNS.clear()
    _RUNS.old = {}
    give_back()


def ngrams(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document's place, n-gram) of some texts: words and starts once a document, shapes as often as they occur."""
    _RUNS.turn()
    raw = [b"".join(map(_RUNS.__getitem__, x.lower().split())) for x in docs]
    t = np.frombuffer(b"".join(raw), dtype="<u4").reshape(-1, 3).astype(np.uint64)
    doc = np.repeat(np.arange(len(docs)), [len(x) // 12 for x in raw])
    h, shape = t[:, 0], t[:, 2].copy()
    same1, same2 = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    again = np.zeros(len(h), bool)
    again[1:] |= same1 & (h[1:] == h[:-1])
    again[2:] |= same2 & (h[2:] == h[:-2])
    shape += np.uint64(16) * again
    mix = lambda x, n: (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - (n - 1).bit_length())).astype(np.int64)
    triple = WORDS + STARTS + (shape[:-2] << np.uint64(10) | shape[1:-1] << np.uint64(5) | shape[2:]).astype(np.int64)
    both = np.sort(np.concatenate([doc * SIZE + mix(h, WORDS), doc * SIZE + WORDS + mix(t[:, 1], STARTS)]))
    once_doc, once = np.divmod(both[np.diff(both, prepend=-1) > 0], SIZE)  # np.unique hashes first, which takes longer
    return np.concatenate([once_doc, doc[2:][same2]]), np.concatenate([once, triple[same2]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a partition: in all its texts, in those of the target."""
    at_work("quality", _forget)
    raw, target = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
    for batch in batches:
        for part in slices(batch):
            doc, gram = ngrams(part.column(1).to_pylist())
            raw += np.bincount(gram, minlength=SIZE)
            good = np.asarray(part.column(2).to_pylist(), dtype=bool)
            target += np.bincount(gram[good[doc]], minlength=SIZE)
    _forget()  # tasks of other operators may come to other workers, while this one waits with what it holds
    seen = np.flatnonzero(raw)
    for at in range(0, len(seen), 1 << 16):
        s = seen[at : at + (1 << 16)]
        yield pa.record_batch([pa.array(s.astype(np.int32)), pa.array(raw[s]), pa.array(target[s])], names=["gram", "raw", "target"])


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of each n-gram from its counts in all texts and in those of the target; each kind of n-gram is a
    distribution of its own."""
    out = np.zeros(SIZE)
    for kind in (slice(0, WORDS), slice(WORDS, WORDS + STARTS), slice(WORDS + STARTS, SIZE)):
        r, t = raw[kind].astype(float), target[kind].astype(float)
        share = t.sum() / max(1.0, r.sum())
        if not 0 < share < 1:  # nothing or all is target
            continue
        if kind.stop == SIZE:
            v = np.log((t + PRIOR) / (r * share + PRIOR))
        else:
            a, b = OWN, OWN * (1 - share) / share
            same = t * math.log(share) + (r - t) * math.log(1 - share)
            own = _lgamma(t + a) + _lgamma(r - t + b) - _lgamma(r + a + b) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
            odds = np.exp(np.clip(own - same, -600, 600)) * DIFFERENT / (1 - DIFFERENT)
            v = odds / (1 + odds) * np.log((t + a) / (r * share + a))
        out[kind] = np.where(r > 0, v - (t * v).sum() / t.sum(), 0)
    return out


def _lgamma(x: np.ndarray) -> np.ndarray:
    values, at = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values.tolist()])[at]


def fit(docs: DataFrame, good: Column) -> np.ndarray:
    """Log ratios by n-gram (as many as there are buckets).

    ``docs`` has doc_id, text; ``good`` is a condition on its columns that marks the target."""
    counts = (docs.select("doc_id", "text", F.coalesce(good, F.lit(False)).alias("good")).mapInArrow(_count, "gram int, raw long, target long")
              .groupBy("gram").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
    gram = counts["gram"].to_numpy()
    raw[gram], target[gram] = counts["raw"].to_numpy(), counts["target"].to_numpy()
    return log_ratios(raw, target)


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, log_weight, ...) of each row of (doc_id, text, ...)."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)  # bounded by the number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("quality", _forget)
        table = sent.value
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                doc, gram = ngrams(part.column(1).to_pylist())
                shape = gram >= WORDS + STARTS
                w = np.bincount(doc, weights=np.where(shape, 0, table[gram]), minlength=n)
                mean = np.bincount(doc, weights=np.where(shape, table[gram], 0), minlength=n) / np.maximum(1, np.bincount(doc[shape], minlength=n))
                yield pa.record_batch([part.column(0), pa.array(w + mean * SHAPES_COUNT), *part.columns[2:]], names=["doc_id", "log_weight", *more])
        _forget()

    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", *more)
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("log_weight", T.DoubleType()), *(rows.schema[c] for c in more)]))


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Cut with the greatest sum of good kept and bad rejected, in the middle of the gap it falls into."""
    if not len(good) or not len(bad):
        return -np.inf
    at = np.unique(np.concatenate([good, bad]))
    kept = 1 - np.searchsorted(np.sort(good), at) / len(good)
    out = np.searchsorted(np.sort(bad), at) / len(bad)
    best = int(np.argmax(kept + out))
    return float(at[best] if not best else (at[best] + at[best - 1]) / 2)


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by counts in ever narrower bins; df should be a written table."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        step = (high - low) / 512
        if step <= 0 or low + step == low:
            break
        slot = F.least(F.floor((F.col(column) - low) / step), F.lit(511))
        inside = df.where(F.col(column).between(low, high))
        above = df.where(F.col(column) > high).count()
        bins = {r[0]: r[1:] for r in inside.groupBy(slot).agg(F.count("*"), F.min(column), F.max(column)).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b][0] >= k:
                break
            above += bins[b][0]
        if (low, high) == bins[b][1:]:
            break
        low, high = bins[b][1:]
    return low


def resample(docs: DataFrame, labels: DataFrame, keep: int | None = None, temperature: float = 1.0, max_labels: int = MAX_LABELS,
             id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, kept[, carried]), one row per input row. ``carried`` is a struct of the columns named by
    ``carry``.

    ``labels`` has doc_id, quality and toxic; good is quality 1 and toxic 0. Labels with a null and labels of absent
    documents are ignored; of an id's repeated labels the smallest counts. Without good labels
    all weights are 1; without rejected ones to compare all are kept. Null text is the empty text, which has weight
    1. Rows that repeat an id have the same noise; ties at the last place are all kept. An empty table gives
    no rows. At temperature 1 the draw is in proportion to the weights; lower ones follow the weights more closely.
    """
    small_batches(docs.sparkSession)
    told = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
            .dropna().groupBy("doc_id").agg(F.min(F.struct((F.col("q") == 1) & (F.col("t") == 0))).alias("s"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    told = written(told.select(F.col("doc_id").alias("l"), F.col("s.col1").alias("good"), (~F.col("s.col1") | (F.xxhash64("doc_id", F.lit("fold")) % 4 == 0)).alias("held")), "quality")
    rows = texts(docs, id_col, text_col)
    # equal texts become one before they are counted, so copies don't make their n-grams frequent
    marked = rows.join(F.broadcast(told.where("not held")), rows["doc_id"] == F.col("l"), "left")
    ratios = fit(marked.groupBy(F.xxhash64("text")).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("good").alias("good")), F.col("good"))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("gumbel")), 11) + 0.5) / float(1 << 53)
    if carry:
        rows = docs.select(*texts_columns(id_col, text_col), F.struct(*[F.col(c) for c in carry]).alias("carried"))
    scored = log_weights(rows, ratios)
    scored = written(scored.withColumn("gumbel_key", F.col("log_weight") / temperature - F.log(-F.log(uniform))), "quality")
    if keep is None:
        held = scored.join(F.broadcast(told.where("held")), F.col("doc_id") == F.col("l")).select("good", "log_weight").toPandas()
        good = held["good"].to_numpy(bool)
        cut = best_cut(held["log_weight"].to_numpy()[good], held["log_weight"].to_numpy()[~good])
        keep = scored.where(F.col("log_weight") >= F.lit(cut)).count()
    kept = F.col("gumbel_key") >= kth_largest(scored.select("gumbel_key"), "gumbel_key", keep) if keep else F.lit(False)
    return scored.select("doc_id", "log_weight", "gumbel_key", kept.alias("kept"), *(["carried"] if carry else []))
