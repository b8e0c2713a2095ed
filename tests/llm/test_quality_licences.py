import random

import numpy as np
from pyspark.sql import functions as F

from martline.llm import licences, quality
from tests.llm.helpers import docs, words


def test_kth_largest(spark):
    rng = random.Random(0)
    values = [rng.choice([0.0, -1e9, 3.5, rng.gauss(0, 1), rng.gauss(0, 1e-6)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 500, 2999, 3000):
        assert quality.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_held_out_accuracy(spark):
    """Good text against rejected words (some fused) and junk; every fourth label is left out of the fit."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        text, kind = words(rng, rng.randrange(20, 400), 800), i % 10
        if kind == 0:
            text = text.replace("wb", "vileterm", 5) + " vileterm vilething"
        if kind == 1:
            text = " ".join(w for w in text.split() for _ in range(9))
        rows.append((i, text, "x", None, None))
        if i < 700:
            labels.append((i, int(kind != 1), int(kind == 0)))
    labels += [(None, 1, 0), (5, None, 1), (99999, 1, 0), (12, 1, 0)]
    rows += [(901, None, "x", None, None), (902, "", "x", None, None), (None, "w1x w2x", "x", None, None)]
    out = quality.resample(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {r.doc_id: r.kept for r in out}
    assert len(out) == len(rows) and got[901] and got[902]
    unlabelled = range(700, 900)
    assert np.mean([got[i] for i in unlabelled if i % 10 > 1]) >= 0.99
    assert np.mean([got[i] for i in unlabelled if i % 10 <= 1]) <= 0.03


def test_draw_size_and_repeatability(spark):
    df = docs(spark, [(i, f"word{i % 7} text", None, None, None) for i in range(400)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    a = quality.resample(df, labels, keep=100, temperature=1.0)
    b = quality.resample(df.repartition(5), labels, keep=100, temperature=1.0)
    kept = {r.doc_id for r in a.where("kept").collect()}
    assert len(kept) == 100 and kept == {r.doc_id for r in b.where("kept").collect()}
    none = spark.createDataFrame([], labels.schema)
    assert quality.resample(df, none).where("kept").count() == 400  # nothing to go by: all are kept
    assert quality.resample(docs(spark, []), labels).count() == 0
    assert quality.resample(df, labels, keep=0).where("kept").count() == 0


def brute_licence(text, template):
    """Greatest number of matches of an unbanded local alignment."""
    index = licences.Index({"t": template})
    w = [index.word.get(x, 0) for x in licences._WORD.findall(text.lower())]
    t, best = index.ids[0], (0, 0)
    before = [(0, 0)] * (len(w) + 1)
    for a in t:
        row = [(0, 0)]
        for j, b in enumerate(w):
            c = max((before[j][0] + (2 if a == b else -1), before[j][1] + (a == b)), (before[j + 1][0] - 1, before[j + 1][1]), (row[j][0] - 1, row[j][1]), (0, 0))
            row.append(c if c[0] > 0 else (0, 0))
            best = max(best, row[-1])
        before = row
    return best[1] / len(t)


def test_licences(spark):
    rng = random.Random(2)
    t = licences.TEMPLATES
    header = t["apache-2.0-header"].split()
    changed = " ".join(w for i, w in enumerate(header) if i % 17)
    rows = {0: None, 1: "", 2: words(rng, 50), 3: words(rng, 20) + ". Released under the MIT License. " + words(rng, 20), 4: changed,
            5: "RELEASED  under\nthe mit-LICENSE! " * 3, 6: " ".join(header[:30]), 7: words(rng, 5000) + " " + t["bsd-2-clause"] + " " + words(rng, 5000),
            8: "İstanbul " + t["cc-by-nc-4.0-notice"] + " ß", 9: "the of and to in the license"}
    out = licences.scan(docs(spark, [(i, x, None, None, None) for i, x in rows.items()])).collect()
    got = {(r.doc_id, r.licence): r for r in out}
    assert rows[3][got[3, "mit-notice"].span_start : got[3, "mit-notice"].span_end] == "Released under the MIT License"
    assert rows[8][got[8, "cc-by-nc-4.0-notice"].span_start : got[8, "cc-by-nc-4.0-notice"].span_end] == t["cc-by-nc-4.0-notice"]
    assert got[7, "bsd-2-clause"].coverage == 1.0 and got[4, "apache-2.0-header"].coverage < 1.0
    assert sum(r.doc_id == 5 for r in out) == 3 and not any(r.doc_id in (0, 1, 2, 9) for r in out)
    for i, text in rows.items():
        for name in t:
            if brute_licence(text or "", t[name]) >= 0.8:
                assert abs(got[i, name].coverage - brute_licence(text, t[name])) < 0.01, (i, name)
            else:
                assert (i, name) not in got
    assert licences.scan(docs(spark, [])).count() == 0
    assert licences.scan(docs(spark), {"own": "w1x w2x w3x"}).count() >= 0


def test_licence_notices_of_the_table(spark, sf):
    """Every whole notice line in the documents is found, and nothing in documents without one of its words."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    found = {(r.doc_id, r.licence) for r in licences.scan(table).collect()}
    for name in ("apache-2.0-notice", "mit-notice", "gpl-3.0-notice", "cc-by-nc-4.0-notice"):
        want = {r.doc_id for r in table.where(F.instr("text", licences.TEMPLATES[name]) > 0).collect()}
        assert want <= {d for d, n in found if n == name}
