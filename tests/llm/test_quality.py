import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from martline.llm import quality
from tests.llm.helpers import odd_docs, words

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def shares(spark):
    """By table: kept share of the clean, toxic and junk labelled documents; of toxic ones that were left out of the fit."""

    def run(sf):
        kept = {r.doc_id: r.kept for r in quality.resample(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
        labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("*", "xxhash64(doc_id, 'fold') % 4 = 0 as held").collect()
        share = lambda test: np.mean([kept[r.doc_id] for r in labels if test(r)])
        return (share(lambda r: r.quality == 1 and r.toxic == 0), share(lambda r: r.toxic == 1), share(lambda r: r.quality == 0 and r.toxic == 0),
                share(lambda r: r.toxic == 1 and r.held))

    return run


def test_planted_documents_of_the_small_tables(shares, sf):
    clean, toxic, junk, held_out = shares(SMALL)
    assert clean >= 0.98 and junk == 0 and toxic <= 0.35 and held_out <= 0.2
    clean, _, junk, _ = shares(sf)  # 11 toxic documents, nine of them for the fit, are too few to tell their words
    assert clean >= 0.98 and junk == 0


def test_every_ratio_counts():
    """Ratios above 1 and weak ones count; a word that 20 of 300 texts have and no good one counts in full."""
    rng = np.random.default_rng(0)
    raw, target = np.zeros(quality.SIZE, np.int64), np.zeros(quality.SIZE, np.int64)
    raw[:5000] = rng.integers(1, 300, 5000)
    target[:5000] = rng.binomial(raw[:5000], 0.75)
    for at, (r, t) in enumerate([(20, 0), (300, 290), (300, 150)]):
        raw[at], target[at] = r, t
    v = quality.log_ratios(raw, target)
    assert v[0] < -2.5 and v[1] > 0.2 and -0.5 < v[2] < -0.3
    assert (v[3:5000] != 0).all() and np.abs(v[3:5000]).mean() < 0.01 and not v[5000:].any()
    assert not quality.log_ratios(raw, raw).any() and not quality.log_ratios(raw, 0 * raw).any()


def test_raw_model_of_all_documents(spark):
    """A family of unlabelled texts with words of its own is told from the target; copies count once."""
    rng = random.Random(3)
    rows = [(i, words(rng, 60, 300)) for i in range(400)]
    rows += [(i, words(rng, 60, 300) + " spamword " + " ".join(rng.sample(["buynow", "cheapest", "casino", "winbig"], 3))) for i in range(400, 500)]
    passage = words(rng, 30, 300) + " rareword otherword"
    rows += [(i, passage) for i in range(500, 600)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    out = quality.resample(spark.createDataFrame(rows, "doc_id long, text string"), labels, keep=450).collect()
    weight = {r.doc_id: r.log_weight for r in out}
    kept = {r.doc_id for r in out if r.kept}
    assert max(weight[i] for i in range(400, 500)) < -3 < min(weight[i] for i in [*range(400), *range(500, 600)])
    assert not kept & set(range(400, 500))


def plain_grams(text):
    """Words and starts once, triples of shapes as often as they occur, as buckets; written out."""
    tokens = [t for run in text.lower().split() for t in quality._TOKEN.findall(run)]
    mix = lambda x, size: (x * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - (size - 1).bit_length())
    crc = lambda t: zlib.crc32(t.encode())
    out = [mix(crc(t), quality.WORDS) for t in set(tokens)]
    starts = {t[: quality.START] for t in tokens}
    out = sorted({*out, *(quality.WORDS + mix(crc(t), quality.STARTS) for t in starts)})
    shape = []
    for i, t in enumerate(tokens):
        kind = 1 if t[0].isalpha() else 2 if t[0].isnumeric() else 3 + zlib.crc32(t.encode()[:2]) % 12
        shape.append(kind + 16 * (i > 0 and tokens[i - 1] == t or i > 1 and tokens[i - 2] == t))
    return out, [quality.WORDS + quality.STARTS + (a << 10 | b << 5 | c) for a, b, c in zip(shape, shape[1:], shape[2:], strict=False)]


def plain_ratio(r, t, share, kind):
    if kind == 2:
        return math.log((t + quality.PRIOR) / (r * share + quality.PRIOR))
    a, b = quality.OWN, quality.OWN * (1 - share) / share
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    odds = math.exp(beta(t + a, r - t + b) - beta(a, b) - t * math.log(share) - (r - t) * math.log(1 - share)) * quality.DIFFERENT / (1 - quality.DIFFERENT)
    return odds / (1 + odds) * math.log((t + a) / (r * share + a))


def test_weights_noise_and_draw_against_plain_python(spark):
    """log_weight, gumbel_key and kept of every row, from counts, ratios, sums, hashes and a sort written out in Python."""
    rng = random.Random(11)
    rows = [(r[0], r[1]) for r in odd_docs(4) if r[0] is None or r[0] < 1000]
    rows += [(100 + i, words(rng, 40, 60) + (" 12, !! q w q" if i % 3 else "")) for i in range(80)] + [(100, "twice given")]
    labels = [(100 + i, int(i % 4 > 0), int(i % 9 == 0)) for i in range(60)] + [(101, 0, None), (102, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = quality.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), keep=50, temperature=1.0).collect()
    told = {}
    for i, q, t in labels:
        if t is not None:
            told[i] = told.get(i, True) and q == 1 and t == 0
    signed = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    number = lambda i: b"" if i is None else struct.pack("<q", i)
    chain = lambda i, tag: xxhash.xxh64_intdigest(tag, seed=xxhash.xxh64_intdigest(number(i), seed=42) if i is not None else 42)
    held = {i for i, g in told.items() if not g or signed(chain(i, b"fold")) % 4 == 0}
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    raw, target = Counter(), Counter()
    for t, ids in texts.items():
        once, triples = plain_grams(t)
        good = any(told.get(i) and i not in held for i in ids)
        raw.update(once + triples)
        target.update(once + triples if good else [])
    kind = lambda g: 0 if g < quality.WORDS else 1 if g < quality.WORDS + quality.STARTS else 2
    ratios = {}
    for k in range(3):
        grams = [g for g in raw if kind(g) == k]
        share = sum(target[g] for g in grams) / sum(raw[g] for g in grams)
        v = {g: plain_ratio(raw[g], target[g], share, k) for g in grams}
        mean = sum(target[g] * v[g] for g in grams) / sum(target[g] for g in grams)
        ratios.update({g: x - mean for g, x in v.items()})
    want = []
    for i, t in rows:
        once, triples = plain_grams(t or "")
        w = sum(ratios[g] for g in once) + (sum(ratios[g] for g in triples) / len(triples) * quality.SHAPES_COUNT if triples else 0)
        u = ((chain(i, b"gumbel") >> 11) + 0.5) / (1 << 53)
        want.append((str(i), w, w - math.log(-math.log(u))))
    least = sorted((g for _, _, g in want), reverse=True)[49]
    got = sorted((str(r.doc_id), r.log_weight, r.gumbel_key, r.kept) for r in out)
    assert len(got) == len(want) and sum(k for *_, k in got) >= 50
    for a, b in zip(got, sorted(want), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-8) and a[2] == pytest.approx(b[2], abs=1e-8)
        assert a[3] == (b[2] >= least - 1e-9)
