import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from martline.llm import lexical
from martline.llm.common import written

from .helpers import docs, odd_docs

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rank", T.StringType()),
                      T.StructField("terms", T.IntegerType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(rows, items, k):
    said = [(r[0], Counter(terms(r[1]))) for r in rows]
    said = [(i, c) for i, c in said if c]
    N, L = len(said), sum(sum(c.values()) for _, c in said)
    df = Counter(t for _, c in said for t in c)
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc_id, c in said:
            m = 100 - 90 + 90 * sum(c.values()) * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                found.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def some_items(rows, seed=1):
    rng = random.Random(seed)
    said = [r[1] for r in rows if r[1] and len(r[1].split()) > 8]
    cut = [" ".join(t.split()[a : a + 30]) for t in rng.sample(said, 12) for a in (0, 3)]
    return [*[(i, t, "r", 1) for i, t in enumerate(cut)], (0, "One ÄÖ two", None, None), (50, None, None, None), (51, "", None, 1), (52, "nowhere", None, 1),
            (53, "ÄÖ äöü naïve a1B", None, None), (None, cut[3], None, None), (-4, cut[5].upper() + " \x00\x0b" + cut[7], None, None)]


@pytest.mark.parametrize("k,segment,block", [(10, 4 << 20, 200_000), (3, 3000, 40), (200, 20_000, 1)])
def test_all_rows_against_a_plain_ranking(spark, monkeypatch, k, segment, block):
    monkeypatch.setattr(lexical, "SEGMENT", segment)  # workers are forked with it on a local master
    rows = odd_docs()
    items = some_items(rows)
    found = lexical.search(lexical.build(docs(spark, rows).repartition(3)), spark.createDataFrame(items, ITEMS), k=k, block_terms=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, items, k)


def test_empty_tables_and_texts(spark):
    rows = odd_docs()
    for d, i in (([], some_items(rows)), (rows, []), ([(1, None, None, None, None), (2, " .. ", None, None, None)], some_items(rows))):
        found = lexical.search(lexical.build(docs(spark, d)), spark.createDataFrame(i, ITEMS))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("ab, c" * 40 + "x" * 500 + " É1 z" * 30).encode()
    whole = lexical.term_counts(text)
    for chunk in (1, 7, 64, 400):
        monkeypatch.setattr(lexical, "CHUNK", chunk)
        assert lexical.term_counts(text) == whole
    assert whole == Counter(t.encode() for t in terms(text.decode()))


def test_reading_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    for n, lists, k in ((50, 1, 5), (400, 6, 10), (400, 6, 1), (2000, 20, 10), (30, 4, 100)):
        docs_, imps = [], []
        for _ in range(lists):
            some = rng.permutation(n)[: rng.integers(1, n + 1)]
            value = np.sort(rng.integers(1, rng.choice([5, 1_000_000]), len(some)))[::-1].astype(np.int64)
            docs_.append(some.astype(np.int32))
            imps.append(value)
        total = np.zeros(n, np.int64)
        for d, x in zip(docs_, imps, strict=True):
            total[d] += x
        for floor in (0, int(np.sort(total)[-k:][0]) if n > k else 0):
            found, score = lexical.nra(docs_, imps, k, floor, n)
            assert (score == total[found]).all()
            kth = max(floor, 1, int(np.sort(total)[-k]) if n >= k else 0)
            assert set(np.flatnonzero(total >= kth)) <= set(found)


def test_the_index_is_sorted_by_impact(spark):
    index = lexical.build(docs(spark))
    assert written(index.segments, "lexical").count() == index.segments.count() > 0
    for r in index.segments.collect():
        starts, impacts = lexical._unpack(bytes(r.starts), "i8"), lexical._unpack(bytes(r.impacts), "i4")
        assert all((np.diff(impacts[a:b]) <= 0).all() for a, b in zip(starts[:-1], starts[1:], strict=True))
