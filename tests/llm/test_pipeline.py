import hashlib
import random

import numpy as np
from pyspark.sql import Row
from tokenizers import Tokenizer

import corpus_pipeline
from martline.session import scratch_path
from martline.llm import quality, repeats, simhash
from tests.llm.helpers import TOKENIZER
from tests.llm.test_dedup import brute_groups, brute_repeats
from tests.llm.test_tokens import check_packing


def test_stages_against_brute_force(spark, sf):
    """Each stage on its predecessor's rows: what the classifier keeps (held-out accuracy is tested by itself), the smallest id of
    each brute-force group, brute-force removal, and packing of every id."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test")
        steps.append(docs)
        if name != "packing":
            assert docs.columns == columns
    good, single, plain, packed = steps
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    clean = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    assert np.mean([d in kept for d in clean]) >= 0.9
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    assert {r.doc_id for r in single.collect()} == {d for d, _, c in brute_groups(rows, 4) if d == c}
    rows = sorted((r.doc_id, r.text) for r in single.collect())
    after = {r.doc_id: r for r in plain.collect()}
    assert len(after) == len(rows)
    for (d, text), want in zip(rows, brute_repeats(rows, 100), strict=True):
        left = after[d].text.encode()
        if text and text.isascii():
            assert hashlib.sha256(left).hexdigest() == want[3]
        assert len(want[4]) <= len(left) <= len(want[4]) + 6 * want[2] and after[d].n_chars == len(after[d].text)
    theirs = Tokenizer.from_file(TOKENIZER)
    want = {d: [*theirs.encode(r.text, add_special_tokens=False).ids, 1] for d, r in after.items()}
    got = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id: r["sum(length)"] for r in got} == {d: len(i) for d, i in want.items()} == {r.doc_id: r["max(doc_tokens)"] for r in got}


def test_odd_rows_pass_through(spark):
    from tests.llm.helpers import docs

    df = docs(spark)
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()} <= {r.doc_id for r in df.collect()}
    path = scratch_path(spark, "test")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    every = corpus_pipeline.keep_good(spark, df, path)  # nothing to go by: all rows stay, repeated and null ids too
    assert sorted(map(str, every.collect())) == sorted(map(str, df.collect()))
    out = corpus_pipeline.drop_repeats(spark, df, "")
    assert out.columns == df.columns and out.count() == df.count()
    assert all(m for m in (quality, repeats, simhash, check_packing))


def test_rows_are_judged_not_ids(spark):
    """Different texts under one id or none stay, near copies of them go whatever their ids; the smallest id stays, null comes last."""
    from tests.llm.helpers import DOCS, words

    rng = random.Random(5)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    rows = [(1, a, "first", 1, "x"), (1, b, "other text", 2, None), (None, c, None, 3, "y"), (None, d, None, 4, None), (None, d, None, 4, None),
            (7, a, None, 5, None), (2, d, "with an id", 6, None), (3, None, None, None, None), (4, "", None, None, None), (5, e, None, 7, None), (5, e, None, 7, None)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS).repartition(3), "")
    assert sorted(map(str, out.collect())) == sorted(str(Row(*DOCS.names)(*r)) for r in (rows[0], rows[1], rows[2], rows[6], rows[7], rows[9]))


def test_scratch_tables_go_with_the_next_stage(spark):
    """What a stage left is deleted when the next one begins, unless that one still reads it."""
    import os

    from martline.llm.common import Tracked, written
    from tests.llm.helpers import docs

    scratch = Tracked()
    with scratch:
        a, b = written(docs(spark), "tracked"), written(docs(spark), "tracked")
    other = written(docs(spark), "untracked")
    paths = list(scratch.paths)
    assert len(paths) == 2
    scratch.clear(spark, a)
    assert [os.path.exists(p.split(":", 1)[-1] if p.startswith("file:") else p) for p in paths] == [True, False]
    assert a.count() == other.count() and b is not None
