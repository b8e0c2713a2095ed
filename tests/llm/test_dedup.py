import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from martline.llm import anchors, bwt, repeats, simhash
from martline.llm.common import components
from tests.llm.helpers import docs, odd_docs, union_find, words


def brute_fingerprint(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_groups(rows, radius):
    fp = [brute_fingerprint(t) for _, t, *_ in rows]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= radius or rows[i][0] == rows[j][0]]
    root = union_find(n, pairs)
    low = {}
    for i in range(n):
        low[root[i]] = min(low.get(root[i], 1 << 60), rows[i][0])
    return sorted((rows[i][0], f"{fp[i]:016x}", low[root[i]]) for i in range(n))


@pytest.mark.parametrize("cell,lanes", [(simhash.CELL, simhash.LANES), (4, 64)])
def test_simhash_equals_brute_force(spark, monkeypatch, cell, lanes):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "LANES", lanes)
    rng = random.Random(4)
    long = words(rng, 600).split()
    rows = odd_docs()[:-2]  # null ids are looked at below
    rows += [(1000 + i, " ".join([*long[:i], "changed", *long[i + 1 :]]), "x", None, None) for i in range(60)]
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs(spark, rows)).collect())
    assert got == brute_groups(rows, 4)
    assert len({g[2] for g in got if g[0] >= 1000}) < 10


def test_simhash_null_ids_and_empty(spark):
    out = simhash.near_duplicates(docs(spark, [(None, "a b c d e", None, None, None), (3, "a b c d e", None, None, None), (None, "only here now", None, None, None)]))
    assert sorted((tuple(r) for r in out.select("doc_id", "component_id").collect()), key=str) == [(3, 3), (None, 3), (None, None)]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("equal", [3, 4])
def test_more_blocks_lose_no_link(spark, monkeypatch, equal):
    """The keys that very large tables get, on a small one."""
    monkeypatch.setattr(simhash, "equal_blocks", lambda n, radius: equal)
    rng = random.Random(6)
    long = words(rng, 300).split()
    rows = [r for r in odd_docs() if r[0] is not None] + [(500 + i, " ".join([*long[: 4 * i], "changed", *long[4 * i + 1 :]]), "x", None, None) for i in range(50)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(spark, rows)).collect()]
    assert sorted(got) == brute_groups(rows, 4)


def test_blocks_grow_with_the_table():
    assert [simhash.equal_blocks(n, 4) for n in (0, 10**6, 10**8, 10**9, 5 * 10**10)] == [2, 2, 2, 3, 4]


def test_close_pairs_find_all_and_only():
    rng = np.random.default_rng(0)
    for radius in (0, 1, 3, 4, 7):
        n = 300
        fp = rng.integers(-(1 << 63), (1 << 63) - 1, n)
        for i in range(1, n):
            if rng.random() < 0.5:
                fp[i] = fp[rng.integers(i)]
                for b in rng.integers(0, 64, rng.integers(0, 9)):
                    fp[i] ^= np.int64(-(1 << 63)) if b == 63 else np.int64(1) << np.int64(b)
        cell = np.sort(rng.integers(0, 4, n))
        last = {c: np.flatnonzero(cell == c).max() for c in cell}
        after = np.array([last[c] - i for i, c in enumerate(cell)])
        got = {(a, b) for i, j in simhash.close_pairs(fp, after, radius) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        u = fp.view(np.uint64)
        assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if cell[i] == cell[j] and int(u[i] ^ u[j]).bit_count() <= radius}


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5)]
    root = union_find(400, pairs)
    rows = [*pairs, (None, 3), (4, None), pairs[0]]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long").repartition(7)).collect()}
    touched = {x for p in pairs if p[0] != p[1] for x in p}
    assert {x: got.get(x, x) for x in touched} == {x: root[x] for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffixes_are_sorted_with_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        strings = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 14)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        data, size = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
        owner, length, common = bwt.suffixes(data, np.cumsum(size) - size, size, 5)
        want = sorted((s[i:], j) for j, s in enumerate(strings) for i in range(len(s)))
        assert [(strings[o][len(strings[o]) - n :], o) for o, n in zip(owner, length, strict=True)] == want
        for k in range(1, len(want)):
            a, b = want[k - 1][0], want[k][0]
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert common[k] == min(same, 5)


def test_pieces_hold_every_window_once(monkeypatch):
    rng = np.random.default_rng(1)
    for place in (22, 7):  # also a buffer taken in parts
        monkeypatch.setattr(anchors, "_PLACE", place)
        anchors._powers.cache_clear()
        for _ in range(20):
            texts = [bytes(rng.integers(97, 100, rng.integers(0, 90)).astype(np.uint8)) for _ in range(6)]
            texts.append(texts[0] + texts[1])
            data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
            seen, found = {}, []
            for a, s, w in zip(*(x.tolist() for x in anchors.pieces(data, ends, 10, 4)), strict=True):
                assert w <= 7
                for i in range(s, s + w):
                    assert seen.setdefault(data[i : i + 10].tobytes(), a) == a
                    found.append(i)
            assert sorted(found) == [e - len(t) + i for t, e in zip(texts, ends.tolist(), strict=True) for i in range(len(t) - 9)]
    anchors._powers.cache_clear()


def brute_repeats(rows, length):
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("many,block,bundle,sample", [(repeats.MANY, repeats.BLOCK, repeats.BUNDLE, 0), (repeats.MANY, 8000, repeats.BUNDLE, 3), (2, 2000, 500, 16)])
def test_repeats_equal_brute_force(spark, monkeypatch, many, block, bundle, sample):
    for name, value in (("MANY", many), ("BLOCK", block), ("BUNDLE", bundle), ("SAMPLE", sample)):
        monkeypatch.setattr(repeats, name, value)  # also with small blocks and bundles, anchors done string by string, without and with hot anchors
    rng = random.Random(8)
    passage = words(rng, 30)
    rows = [r for r in odd_docs()[:-4]]  # one row an id
    rows += [(100 + i, f"{words(rng, 12)} {passage} {words(rng, 12)}", "x", None, None) for i in range(40)]
    rng.shuffle(rows)
    df = docs(spark, rows).repartition(3)
    got = {r.doc_id: r for r in repeats.remove_repeats(df, text="bytes", carry=["component_id", "ids"]).collect()}
    rows.sort()
    for (d, *_), want in zip(rows, brute_repeats([r[:2] for r in rows], 100), strict=True):
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == want, d
        assert r.carried.component_id == "x" and sum(s.length for s in r.spans) == r.n_removed
    assert sum(r.n_removed for r in got.values()) > 5000


def test_repeats_odd_rows(spark):
    df = docs(spark)
    out = repeats.remove_repeats(df, text="letters")
    rows = out.collect()
    assert len(rows) == df.count() and sum(r.doc_id is None for r in rows) == 2
    for r in rows:
        r.kept.decode()  # letters stay whole
    assert sorted(r.n_removed for r in rows if r.doc_id == 7)[-1] > 0  # a row that repeats an id is a document of its own
    assert repeats.remove_repeats(docs(spark, [])).count() == 0
    with pytest.raises(AssertionError):
        repeats.remove_repeats(df, length=100, gram=20)
