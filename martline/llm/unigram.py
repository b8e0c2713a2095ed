"""Token counts of a unigram tokenizer without building tokens: count-only Viterbi.

An Aho-Corasick automaton enumerates every vocabulary match by its end; dynamic programming keeps, for each
place, the best score and the number of pieces on that path. Ties go to the piece that begins first, and the
unknown edge (a character that is no piece by itself) comes last and must be strictly better: the order in which
the tokenizer's own search meets them.

Blanks become a mark and the text gets one in front. If no piece goes from another character to a mark, the
best path of a text is that of its words one after another, so counts of words are kept and reused; else the
text is searched as a whole. Scores that are whole numbers (as in the vocabulary used here) add exactly, so
the split can't change a tie.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from martline.llm.common import Recent, at_work, slices, small_batches, texts

MARK = "▁"
#: Distinct words whose counts a worker keeps, at most about twice as many.
KEEP_WORDS = 400_000
#: What an unknown character scores below the worst piece.
UNKNOWN_BELOW = 10.0


class Unigram:
    def __init__(self, pieces: Iterable[tuple[str, float]], byte_fallback: bool = True) -> None:
        vocab = dict(pieces)
        self.auto = ahocorasick.Automaton()
        for p, score in vocab.items():
            if p:
                self.auto.add_word(p, (len(p), score))
        self.auto.make_automaton()
        self.unknown = min(vocab.values()) - UNKNOWN_BELOW
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in vocab for b in range(256))
        self.by_words = MARK in vocab and not any(re.search(f"[^{MARK}]{MARK}", p) for p in vocab)
        self.words = Recent(lambda word: self.search(MARK + word), KEEP_WORDS)  # pieces of words without the mark in front

    def search(self, text: str) -> int:
        """Pieces on the best path through ``text``."""
        n = len(text)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.auto.iter(text)  # by end; at one end, long to short
        end, match = next(matches, (n, None))
        for i in range(n):
            best, pieces, odd, single = None, 0, False, False
            while end == i:
                size, add = match
                single = single or size == 1
                at = i + 1 - size
                if best is None or score[at] + add > best:
                    best, pieces = score[at] + add, count[at] + 1
                end, match = next(matches, (n, None))
            if not single and (best is None or score[i] + self.unknown > best):
                best, odd = score[i] + self.unknown, True
                # unknown characters in a row are one piece, unless they fall back to bytes
                pieces = count[i] + (len(text[i].encode("utf-8", "replace")) if self.bytes else not unknown[i])
            score[i + 1], count[i + 1], unknown[i + 1] = best, pieces, odd
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_words:
            text = text.replace(" ", MARK)
            return self.search(text if text[0] == MARK else MARK + text)
        self.words.turn()
        if MARK not in text and "  " not in text and text[0] != " ":
            return sum(map(self.words.__getitem__, text.split(" ")))
        text = text.replace(" ", MARK)
        if text[0] != MARK:
            text = MARK + text
        return sum(self.words[run[1:]] for run in re.findall(f"{MARK}+[^{MARK}]*", text))


def pieces_of(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece model file, in the order of ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


def unigram(path: str, byte_fallback: bool = True) -> Unigram:
    """One counter for a worker process; the file must be at the same path on every executor."""
    at_work("unigram", _unigram.cache_clear)
    return _unigram(path, byte_fallback)


@functools.lru_cache(1)
def _unigram(path: str, byte_fallback: bool) -> Unigram:
    return Unigram(pieces_of(path), byte_fallback)


def token_counts(df: DataFrame, model: str, byte_fallback: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every whole text under the pieces and scores of ``model``.

    Null text is the empty text (0 tokens); rows that repeat stay; a null id stays null; an empty table gives no
    rows. Narrow: no shuffle. A word may be as long as a text; the search is linear in it."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = unigram(model, byte_fallback)
        for batch in batches:
            for part in slices(batch):
                n = [u.count(x) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long")
