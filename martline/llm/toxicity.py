"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from labels of whole documents.

A sentence has a logit, the bias plus the weights of its different words; a word's weight is the sum over its features, itself and its
starts of ``STARTS`` letters. A document is clean if none of its sentences is toxic and no leak (a label that no sentence explains)
occurs: P(toxic) = 1 - (1 - leak) * product of (1 - p) over the sentences. Only document labels are told; the likelihood shares
the blame among the sentences, and those with a high p are the offending ones.

Training is a series of Spark jobs over the labelled documents, equal texts with one label once:

1. Features are counted by label. Kept are those that occur in at least ``MIN_DOCS`` toxic documents, more often than chance lets
   expect: at most ``MAX_FEATURES``, the surest first.
2. Documents become their sentences' kept features, with the sentences that have none as a number.
3. Loss and gradient, of one number a feature, are summed over all partitions for each step of L-BFGS on the driver.

Labels are a bounded sample (``max_labels``, smallest hashes of ids), so that they can be broadcast; every document is scored.
"""

from __future__ import annotations

import functools
import re
import struct
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import Recent, at_work, discard, give_back, slices, small_batches, texts, written

MAX_LABELS = 100_000
#: Toxic documents that a feature must occur in, how sure (standard deviations over chance) and how many are kept.
MIN_DOCS, SURE, MAX_FEATURES = 3, 3.0, 4096
#: Letters of the starts of words that are features beside the words, without gaps.
STARTS = (4, 5, 6, 7, 8)
#: Penalty on squared weights, steps of the fit.
PENALTY, STEPS = 0.02, 40
#: Words whose features or weights a worker keeps, at most about twice as many.
KEEP_WORDS = 200_000
_SENTENCE = re.compile(r"[^.!?\n。！？]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, different words in lower case) of the sentences with words; white space around them is left out."""
    out = []
    for m in _SENTENCE.finditer(text):
        part = m.group()
        words = set(_WORD.findall(part.lower()))
        if words:
            lead = len(part) - len(part.lstrip())
            out.append((m.start() + lead, m.end() - len(part) + len(part.rstrip()), words))
    return out


@functools.cache
def _characters() -> np.ndarray:
    """What ``spread`` makes of each character in lower case."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    out = np.full(len(every), ord("\n"), "<u4")
    for m in _SENTENCE.finditer(every):
        out[slice(*m.span())] = ord(" ")
    for m in _WORD.finditer(every):
        out[slice(*m.span())] = range(*m.span())
    return out


@functools.cache
def _latin() -> bytes:
    """The same for Latin-1, with the lower case."""
    return bytes(_characters()[[ord(chr(c).lower()) for c in range(256)]].astype(np.uint8))


def spread(text: str) -> str:
    """The text in lower case with a blank for each character that is not of a word, a line feed where a sentence ends. Words
    come apart by ``split``, several times as fast as by one match a word."""
    try:
        return text.encode("latin-1").translate(_latin()).decode("latin-1")
    except UnicodeEncodeError:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        return _characters()[codes].tobytes().decode("utf-32-le")


def plain_count(text: str, some: Callable[[set[str]], bool]) -> int | None:
    """How many sentences with words a text has, if ``some`` is false of all its words; null if they must be looked at one by one. (The
    lower case of a sigma depends on what follows, which may be another sentence.)"""
    if "\u03a3" in text:
        return None
    flat = spread(text)
    return None if some(set(flat.split())) else sum(map(bool, map(str.strip, flat.split("\n"))))


def told_sentences(text: str, cache: Recent) -> tuple[int, list[tuple[int, int, list[str]]]]:
    """How many sentences with words have none with a value in ``cache``; (start, end, different words with a value) of the others,
    white space around them included."""
    if "\u03a3" in text or len(flat := spread(text)) != len(text):  # places are not those of the lower case
        parts = sentences(text)
    else:
        lines = flat.split("\n")
        ends = accumulate(len(x) + 1 for x in lines)
        parts = ((end - 1 - len(x), end - 1, words) for x, end in zip(lines, ends, strict=True) if (words := set(x.split())))
    plain, told = 0, []
    for start, end, words in parts:
        if found := [w for w in words if cache[w]]:
            told.append((start, end, found))
        else:
            plain += 1
    return plain, told


def _feature(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) >> 1


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and its starts; a start is not the word that is as long."""
    return tuple(map(_feature, ["w" + word, *("s" + word[:n] for n in STARTS if len(word) >= n)]))


class Words(Recent):
    """By word, the sum of what ``value`` gives for each of its features. What a start and the shorter ones give is kept too, as many
    words begin alike."""

    def __init__(self, value: Callable[[int], Any], keep: int) -> None:
        super().__init__(self._word, keep)
        self.value, self.starts = value, Recent(self._start, keep)

    def _word(self, word: str) -> Any:
        own = self.value(_feature("w" + word))
        return own + self.starts[word[: STARTS[-1]]] if len(word) >= STARTS[0] else own

    def _start(self, start: str) -> Any:
        own = self.value(_feature("s" + start))
        return self.starts[start[:-1]] + own if len(start) > STARTS[0] else own

    def turn(self) -> None:
        super().turn()
        self.starts.turn()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, n): documents of a partition that a feature occurs in, by label. What is counted is given out and begun anew
    when it gets large."""
    at_work("toxicity")
    cache = Words(struct.Struct("<q").pack, KEEP_WORDS)
    counts = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]

    def out(label: int) -> pa.RecordBatch:
        f, n = counts[label]
        counts[label] = (f[:0], n[:0])
        return pa.record_batch([pa.array(f), pa.array(np.full(len(f), label, np.int32)), pa.array(n)], names=["feature", "toxic", "n"])

    for batch in batches:
        for part in slices(batch, 0):
            cache.turn()
            new: list[list[np.ndarray]] = [[], []]
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                f = np.sort(np.frombuffer(b"".join(map(cache.__getitem__, set(spread(text).split()))), "<i8"))
                new[label].append(f[np.diff(f, prepend=-1) > 0])
            for label, arrays in enumerate(new):
                f, n = counts[label]
                f, back = np.unique(np.concatenate([f, *arrays]), return_inverse=True)
                ones = np.ones(len(back) - len(n), np.int64)
                counts[label] = f, np.bincount(back, weights=np.concatenate([n, ones]), minlength=len(f)).astype(np.int64)
                if len(f) > 500_000:
                    yield out(label)
    for label in range(2):
        yield out(label)
    give_back()


def _instances(number: dict[int, int]) -> Callable:
    """Labelled documents as (toxic, empty, sizes, features): kept features (places) sentence after sentence, ``sizes`` how many
    each has, ``empty`` the sentences without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("toxicity")
        cache = Words(lambda f: (number[f],) if f in number else (), KEEP_WORDS)
        some = lambda words: any(map(cache.__getitem__, words))
        for batch in batches:
            for part in slices(batch, 0):
                cache.turn()
                empty, sizes, features = [], [], []
                for text in part.column(0).to_pylist():
                    n = plain_count(text, some)
                    n, told = told_sentences(text, cache) if n is None else (n, [])
                    found = [[f for w in sorted(words) for f in cache[w]] for _, _, words in told]
                    empty.append(n)
                    sizes.append([len(x) for x in found])
                    features.append([f for x in found for f in x])
                yield pa.record_batch([part.column(1), pa.array(empty, pa.int64()), pa.array(sizes, pa.list_(pa.int32())), pa.array(features, pa.list_(pa.int32()))],
                                      names=["toxic", "empty", "sizes", "features"])

    return run


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def loss_and_gradient(weights: np.ndarray, toxic: np.ndarray, empty: np.ndarray, doc: np.ndarray, size: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Negative log likelihood of some documents, then its gradient. ``weights``: leak, bias, features; ``doc`` and ``size`` are
    by sentence, ``feature`` goes through the sentences one after another."""
    leak, bias, w = weights[0], weights[1], weights[2:]
    sentence = np.repeat(np.arange(len(size)), size)
    z = bias + np.bincount(sentence, weights=w[feature], minlength=len(size))
    total = _softplus(leak) + empty * _softplus(bias) + np.bincount(doc, weights=_softplus(z), minlength=len(toxic))  # -log P(clean)
    total = np.maximum(total, 1e-12)
    loss = np.where(toxic == 1, -np.log(-np.expm1(-total)), total)
    slope = np.where(toxic == 1, -1 / np.expm1(np.minimum(total, 700)), 1.0)
    dz = slope[doc] * _sigmoid(z)
    out = np.empty(len(weights) + 1)
    out[:3] = loss.sum(), slope.sum() * _sigmoid(leak), (slope * empty).sum() * _sigmoid(bias) + dz.sum()
    out[3:] = np.bincount(feature, weights=dz[sentence], minlength=len(w))
    return out


def _evaluate(instances: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Loss and gradient over all instances, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(weights) + 1)
        for b in batches:
            sizes, features = b.column("sizes"), b.column("features")
            doc = np.repeat(np.arange(b.num_rows), np.diff(sizes.offsets.to_numpy()))
            out += loss_and_gradient(weights, b.column("toxic").to_numpy(), b.column("empty").to_numpy(), doc,
                                     sizes.flatten().to_numpy(), features.flatten().to_numpy())
        some = np.flatnonzero(out)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(out[some])], names=["place", "value"])

    out = np.zeros(len(weights) + 1)
    for r in instances.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():  # one a feature
        out[r.place] = r.value
    return out


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, keep: int = 8) -> np.ndarray:
    """L-BFGS with a halved step where the loss does not fall enough."""
    past: list[tuple[np.ndarray, np.ndarray]] = []
    loss, g = f(x)
    for _ in range(steps):
        d, used = -g, []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            used.append(a)
            d = d - a * y
        d = d * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).max()))
        for (s, y), a in zip(past, reversed(used), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        step = 1.0
        while step > 1e-4:
            new_loss, new_g = f(x + step * d)
            if new_loss <= loss + 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            return x
        s, y = step * d, new_g - g
        if s @ y > 1e-10 * np.linalg.norm(s) * np.linalg.norm(y):
            past = [*past[1 - keep :], (s, y)]
        fell = loss - new_loss
        x, loss, g = x + s, new_loss, new_g
        if fell < 1e-4 * max(1.0, abs(loss)) ** 0.5 and fell < 1e-4 * abs(loss):
            return x
    return x


@dataclass
class Model:
    """Logits of leak and sentence bias, weights by feature. Bounded by the number of features."""

    leak: float
    bias: float
    weights: dict[int, float] = field(default_factory=dict)


def train(docs: DataFrame, labels: DataFrame, use: Column | None = None, max_labels: int = MAX_LABELS, max_features: int = MAX_FEATURES,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model of the documents that ``labels`` (doc_id, toxic) marks; ``use`` is a condition on doc_id that limits the labels.

    Labels with a null or of absent documents are ignored, of an id's repeated labels the largest counts. Without toxic
    or without clean labels there is nothing to tell apart: all documents get the share of toxic labels (0 if there are none)."""
    small_batches(docs.sparkSession)
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    told = told if use is None else told.where(use)
    told = told.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    told = written(told.select(F.col("doc_id").alias("l"), "toxic"), "toxicity")
    rows = texts(docs, id_col, text_col)
    rows = rows.join(F.broadcast(told), rows["doc_id"] == F.col("l")).groupBy(F.xxhash64("text"), "toxic").agg(F.first("text").alias("text"))
    rows = written(rows.select("text", "toxic"), "toxicity")
    seen = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = seen.get(1, 0), seen.get(0, 0)
    if not toxic or not clean:
        return Model(np.inf if toxic else -np.inf, -np.inf)
    both = rows.mapInArrow(_count, "feature long, toxic int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
    expected = F.col("n") * (toxic / (toxic + clean))
    both = both.withColumn("sure", (F.col("bad") - expected) / F.sqrt(expected + 0.1)).where((F.col("bad") >= MIN_DOCS) & (F.col("sure") >= SURE))
    features = [r.feature for r in both.orderBy(F.desc("sure"), "feature").limit(max_features).collect()]
    number = {f: i for i, f in enumerate(features)}
    instances = written(rows.mapInArrow(_instances(number), "toxic int, empty long, sizes array<int>, features array<int>"), "toxicity")

    def f(w: np.ndarray) -> tuple[float, np.ndarray]:
        out = _evaluate(instances, w)
        return float(out[0] + PENALTY * (w[2:] @ w[2:])), out[1:] + np.concatenate([[0, 0], 2 * PENALTY * w[2:]])

    w = minimise(f, np.concatenate([[-5.0, -6.0], np.zeros(len(features))]), STEPS)
    for x in (told, rows, instances):
        discard(docs.sparkSession, x)
    return Model(float(w[0]), float(w[1]), dict(zip(features, w[2:].tolist(), strict=True)))


SCORED = "doc_id long, score double, sentences array<struct<start:long,length:long,score:double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model, offending: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, sentences), one row per input row: the probability that the document is toxic, and the sentences (start and
    length in characters, probability) with at least ``offending``.

    Null text is the empty text, which only the leak can make toxic, like any text without words. Scores need nothing but the text."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("toxicity")
        m = sent.value
        cache = Words(lambda f: m.weights.get(f, 0.0), KEEP_WORDS)
        some = lambda words: any(map(cache.__getitem__, words))
        usual = float(_softplus(np.float64(m.bias)))
        for batch in batches:
            for part in slices(batch):
                cache.turn()
                out, spans = [], []
                for text in part.column(1).to_pylist():
                    total, found = float(_softplus(np.float64(m.leak))), []
                    n = plain_count(text, some)
                    n, told = told_sentences(text, cache) if n is None else (n, [])
                    total += n * usual if n else 0.0
                    for start, end, words in told:
                        z = m.bias + sum(map(cache.__getitem__, words))
                        total += float(np.logaddexp(0.0, z))
                        p = float(np.exp(-np.logaddexp(0.0, -z)))
                        if p >= offending:
                            said = text[start:end]
                            found.append({"start": start + len(said) - len(said.lstrip()), "length": len(said.strip()), "score": p})
                    out.append(float(-np.expm1(-total)))
                    spans.append(found)
                yield pa.record_batch([part.column(0), pa.array(out), pa.array(spans, _SPANS)], names=["doc_id", "score", "sentences"])
        give_back()

    return texts(docs, id_col, text_col).mapInArrow(run, SCORED)
