import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from martline.llm import codec, packing, unigram
from martline.llm.bpe import WordBPE
from tests.llm.helpers import PIECES, TOKENIZER, docs, odd_docs

ODD = ["", "  ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>x", "I'll don't WE'RE 's'S", "ΣΣ ΑΣ", "İstanbul", "é́ ẛ̣", "\x1c a\x1db\x85c​d᠎e", "123 45a6!!??",
       "日本語テキスト", "😀 👩‍👩‍👧", "a\x00b", " x　y", "a" * 300, "!" * 50, "<|endoftext", "İ̇", "ﬁ ǅ ẞ", " a  b ", "▁", "a▁b", "<0x41>x", "<s>a</s>", "͸͹ x͸"]


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdethinorsßéñü'’.,!?0189 \n\t<|>Σσς日́‍😀▁"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(800)] + [
        "".join(rng.choice("abinthe") for _ in range(rng.randrange(1, 40))) for _ in range(800)]


def test_bpe_equals_the_library():
    ours, theirs = WordBPE(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for x in texts(1):
        ids = theirs.encode(x, add_special_tokens=False).ids
        assert ours.encode(x).tolist() == ids, x
        assert ours.decode(np.array(ids, np.uint32)) == theirs.decode(ids, skip_special_tokens=False).encode(), x


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_equals_the_library(fallback):
    vocab = unigram.pieces_of(PIECES)
    theirs = Tokenizer(models.Unigram(vocab, 0, fallback))
    theirs.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", False)
    ours = unigram.Unigram(vocab, fallback)
    for x in texts(2):
        assert ours.count(x) == len(theirs.encode(x, add_special_tokens=False).ids), x


def test_unigram_whole_text_search_and_ties():
    vocab = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("b▁", -2.0), ("▁a", -2.0), ("aab", -3.0)]
    theirs = Tokenizer(models.Unigram(vocab, 0, False))
    theirs.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", False)
    ours = unigram.Unigram(vocab, False)
    assert not ours.by_words  # a piece goes from a letter to the mark
    rng = random.Random(3)
    for _ in range(500):
        x = "".join(rng.choice("aab cc") for _ in range(rng.randrange(0, 20)))
        assert ours.count(x) == len(theirs.encode(x, add_special_tokens=False).ids), x


def test_operators_on_odd_rows(spark):
    theirs = Tokenizer.from_file(TOKENIZER)
    want = sorted(((d, theirs.encode(t or "", add_special_tokens=False).ids) for d, t, *_ in odd_docs()), key=str)
    got = codec.encode(docs(spark), TOKENIZER)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got.collect()), key=str) == want
    back = sorted(((r.doc_id, r.text) for r in codec.decode(got, TOKENIZER).collect()), key=str)
    assert back == sorted(((d, theirs.decode(i, skip_special_tokens=False)) for d, i in want), key=str)
    digest = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in codec.encode_digest(docs(spark), TOKENIZER).collect()}
    assert digest == {(d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest()) for d, i in want}
    assert unigram.token_counts(docs(spark), PIECES).count() == len(want)
    for f in (codec.encode, codec.encode_digest, packing.pack):
        assert f(docs(spark, []), TOKENIZER).count() == 0


def check_packing(pieces, want, window):
    """Every id once, sequences gapless and padded only up to a power of two."""
    by_seq, by_doc = {}, {}
    for r in pieces:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    lengths = []
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    assert max(lengths, default=0) <= window
    for d, ids in want.items():
        got = sorted(by_doc.pop(d), key=lambda r: r.start)
        assert b"".join(r.ids for r in got) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in got] == list(np.cumsum([0, *(r.length for r in got)])[:-1]) and {r.doc_tokens for r in got} == {len(ids)}
    assert not by_doc
    return lengths


def test_packing(spark):
    theirs = Tokenizer.from_file(TOKENIZER)
    rows = [(i, t, "x", None, None) for i, (_, t, *_) in enumerate(odd_docs())]
    want = {d: [*theirs.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in rows}
    lengths = check_packing(packing.pack(docs(spark, rows).repartition(2), TOKENIZER).collect(), want, 2048)
    assert all(n & (n - 1) == 0 for n in lengths)  # full, or a power of two: no padding
    assert sum(n < 2048 for n in lengths) <= 2 * 11


def test_packing_query_on_whole_table(spark, sf):
    from martline.llm.queries import QUERIES

    theirs = Tokenizer.from_file(TOKENIZER)
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), TOKENIZER).collect()
    check_packing(pieces, {r.doc_id: [*theirs.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table}, 2048)
    names = QUERIES["op4_packing"](spark, sf).columns
    assert names[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_best_fit_takes_the_tightest_window():
    tree = packing.Capacities(16)
    for w, c in enumerate((5, 9, 9, 16, 3)):
        tree.add(c, w)
    assert tree.take(4)[0] == 5 and tree.take(4)[0] == 9 and tree.take(10)[0] == 16 and tree.take(10) is None and tree.take(1)[0] == 3
    rng = random.Random(5)
    for _ in range(200):
        lengths = [rng.randrange(1, 64) for _ in range(rng.randrange(0, 40))]
        seen = [set() for _ in lengths]
        for b in packing.best_fit(lengths, 64):
            n = sum(p[2] for p in b)
            assert n & (n - 1) == 0 and n <= 64
            for k, a, m in b:
                assert not seen[k] & set(range(a, a + m))
                seen[k] |= set(range(a, a + m))
        assert [len(s) for s in seen] == lengths
