import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import toxicity
from martline.llm.queries import op12_toxicity

from .helpers import DOCS, LETTERS, docs, odd_docs

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()), T.StructField("score", T.StringType())])
BAD = ["Bletherskite!", "you WIGGLESNITCH of", "a crumblefoot"]


def corpus(n=240, seed=0):
    """Documents of sentences; a third have one or two with a bad word."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 6)))
    usual = [word() for _ in range(150)]
    rows, labels, bad = [], [], {}
    for i in range(n):
        parts = [" ".join(rng.choices(usual, k=rng.randrange(3, 12))) for _ in range(rng.randrange(1, 25))]
        toxic = i % 3 == 0
        for at in rng.sample(range(len(parts)), min(len(parts), rng.randrange(1, 3))) if toxic else ():
            parts[at] += " " + rng.choice(BAD)
            bad.setdefault(i, set()).add(at)
        rows.append((i, ". ".join(parts) + ".", "x", None, None))
        labels.append((i, int(toxic), None))
    return rows, labels, bad


def plain_score(model, text):
    clean = 1 / (1 + np.exp(model.leak))
    for s in toxicity._SENTENCE.findall(text or ""):
        words = set(toxicity._WORD.findall(s.lower()))
        if words:
            clean *= 1 / (1 + np.exp(model.bias + sum(model.weights.get(f, 0) for w in words for f in toxicity.word_features(w))))
    return 1 - clean


def test_held_out_documents_and_their_sentences(spark):
    rows, labels, _ = corpus()
    held = F.col("doc_id") % 4 == 1
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, LABELS), use=~held)
    out = {r.doc_id: r for r in toxicity.score(docs(spark, rows), model).collect()}
    right = sum((out[i].score >= 0.7) == bool(y) for i, y, _ in labels if i % 4 == 1)
    assert right >= 0.98 * sum(i % 4 == 1 for i, *_ in labels)
    words = [w.lower().strip("!") for b in BAD for w in b.split() if len(w) > 4]
    for i, text, *_ in rows:
        for s in out[i].sentences:
            assert any(w in text[s.start : s.start + s.length].lower() for w in words)
        if out[i].score >= 0.7:
            assert out[i].sentences
        assert out[i].score == pytest.approx(plain_score(model, text), abs=1e-12)


def test_training_ignores_labels_that_are_not_to_be_used(spark):
    rows, labels, _ = corpus(90)
    some = toxicity.train(docs(spark, rows), spark.createDataFrame([x for x in labels if x[0] % 2], LABELS))
    flipped = [(i, y if i % 2 else 1 - y, s) for i, y, s in labels]
    used = toxicity.train(docs(spark, rows), spark.createDataFrame(flipped, LABELS), use=F.col("doc_id") % 2 == 1)
    assert some.weights.keys() == used.weights.keys()
    assert [used.leak, used.bias, *[used.weights[f] for f in some.weights]] == pytest.approx([some.leak, some.bias, *some.weights.values()], rel=1e-6)


def test_gradient_is_that_of_the_likelihood(spark):
    rng = np.random.default_rng(0)
    n, k = 30, 7
    doc = np.sort(rng.integers(0, n, 60))
    size = rng.integers(1, 5, 60)
    data = (rng.integers(0, 2, n), rng.integers(0, 9, n), doc, size, rng.integers(0, k, size.sum()))
    w = rng.normal(size=k + 2) * 0.4 - np.r_[2, 2, np.zeros(k)]
    g = toxicity.loss_and_gradient(w, *data)
    for j in range(k + 2):
        d = np.eye(k + 2)[j] * 1e-6
        assert g[1 + j] == pytest.approx((toxicity.loss_and_gradient(w + d, *data)[0] - toxicity.loss_and_gradient(w - d, *data)[0]) / 2e-6, abs=1e-4)
    at = np.cumsum(size) - size  # the loss, written out
    logit = w[1] + np.array([w[2:][data[4][a : a + s]].sum() for a, s in zip(at, size, strict=True)])
    clean = 1 / (1 + np.exp(w[0])) / (1 + np.exp(w[1])) ** data[1] * np.array([np.prod(1 / (1 + np.exp(logit[doc == i]))) for i in range(n)])
    assert g[0] == pytest.approx(-np.log(np.where(data[0] == 1, 1 - clean, clean)).sum())


def test_minimum_of_a_known_function():
    a = np.diag([1.0, 10.0, 100.0])
    x = toxicity.minimise(lambda x: (float((x - 1) @ a @ (x - 1)) + 5, 2 * a @ (x - 1)), np.zeros(3), 60)
    assert np.abs(x - 1).max() < 0.05


def test_odd_rows_and_labels(spark):
    rows = odd_docs()
    base, labels, _ = corpus(60)
    odd = [*labels, (None, 1, "a"), (3, None, None), (99999, 1, None), (0, 0, None), (0, 1, "b")]
    model = toxicity.train(docs(spark, base), spark.createDataFrame(odd, LABELS))
    out = toxicity.score(docs(spark, rows), model)
    assert out.columns == ["doc_id", "score", "sentences"]
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (0, 1, 2)}  # null, empty, only white space
    assert len(empty) == 1 and empty.pop() < 0.2
    assert toxicity.score(docs(spark, []), model).count() == 0


@pytest.mark.parametrize("labels,share", [([], 0.0), ([(1, 0, None)], 0.0), ([(1, 1, None)], 1.0), ([(None, 1, None), (2, None, None)], 0.0)])
def test_one_sided_labels(spark, labels, share):
    rows, *_ = corpus(10)
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert {r.score for r in toxicity.score(docs(spark, rows), model).collect()} == {share}


def test_sentences_have_their_places():
    text = "  One two. \n x!y\t? 123 ...ÄB ä1b。 zz"
    assert [(text[a:b], w) for a, b, w in toxicity.sentences(text)] == [
        ("One two", {"one", "two"}), ("x", {"x"}), ("y", {"y"}), ("ÄB ä1b", {"äb", "ä", "b"}), ("zz", {"zz"})]
    assert toxicity.sentences("") == [] and LETTERS and DOCS


def test_query_holds_its_contract(spark, sf):
    out = op12_toxicity(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in out)


def test_counting_sentences_without_looking_at_them():
    for text in ["", "  One two. \n x!y\t? 123 ...ÄB ä1b。 zz", "1. 2. 3", "a.b.c d", "...", "é! ñ? 日本。x", "_a_ 1b_ . __"]:
        assert toxicity.plain_count(text, lambda words: False) == len(toxicity.sentences(text))
        words = {w for _, _, s in toxicity.sentences(text) for w in s}
        seen = []
        toxicity.plain_count(text, lambda w: bool(seen.append(w)))
        assert seen == [words]
    assert toxicity.plain_count("ΑΣ.Β", lambda words: False) is None and toxicity.plain_count("a b", lambda words: "b" in words) is None


MIXED = ["", "  One two. \n x!y\t? 123 ...ÄB ä1b。 zz", "İstanbul’da a1b. İ!", "ΑΣ.Β ΑΣ", "é! ñ²? 日本。x", "_a_ 1b_ . __", "a\u00a0b\x85c\r\nd\u2028e — f.", "ǅ ß ſ K. 𝔘𝔫𝔦"]


def test_words_come_apart_as_the_pattern_has_them():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for text in [*MIXED, "".join(every[:256]), " ".join(every[:256]), "".join(every), "a".join(every)]:
        flat = toxicity.spread(text)
        assert flat.split() == toxicity._WORD.findall(text.lower())
        assert [x.split() for x in flat.split("\n") if x.strip()] == [w for s in toxicity._SENTENCE.findall(text.lower()) if (w := toxicity._WORD.findall(s))]


def test_sentences_with_told_words_and_number_of_the_others():
    for value in [lambda w: len(w) > 1, lambda w: "b" in w or not w.isascii(), lambda w: True, lambda w: False]:
        for text in MIXED:
            plain, told = toxicity.told_sentences(text, toxicity.Recent(value, 100))
            all_of_it = [(text[a:b], {w for w in words if value(w)}) for a, b, words in toxicity.sentences(text)]
            assert [(text[a:b].strip(), set(w)) for a, b, w in told] == [x for x in all_of_it if x[1]]
            assert plain == sum(not w for _, w in all_of_it)


def test_starts_that_words_share_are_hashed_once(monkeypatch):
    hashed, feature = [], toxicity._feature
    monkeypatch.setattr(toxicity, "_feature", lambda name: (hashed.append(name), feature(name))[1])
    words = ["a", "walk", "walking", "walked", "walkingstick", "walkingsticks", "größenwahn", "größe"]
    cache = toxicity.Words(lambda f: (f,), 100)
    assert [cache[w] for w in words * 2] == [toxicity.word_features(w) for w in words * 2]
    hashed.clear()
    cache = toxicity.Words(lambda f: (f,), 100)
    for w in words * 2:
        cache[w]
    assert len(hashed) == len(set(hashed)) == len({x for w in words for x in ["w" + w, *("s" + w[:n] for n in toxicity.STARTS if len(w) >= n)]})
