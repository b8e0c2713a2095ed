"""Byte-level BPE with word ends: backtracking encoder and offset-table decoder.

The encoder finds a word's vocabulary matches with an Aho-Corasick automaton, takes the longest match at each
place and accepts it only if it is compatible with the token before (no merge across their border would have come
first); on a conflict it tries the next shorter match or steps back. Each place is given up at most once, so
the work is linear in the word. This yields the same ids as applying merges by rank.

Words repeat, so each worker keeps the ids of words that it has seen (bounded, then begun anew).
"""

from __future__ import annotations

import functools
import json
import unicodedata
from array import array

import ahocorasick
import numpy as np
import regex

from martline.llm.common import Recent, at_work

#: Distinct words whose ids a worker keeps, at most about twice as many.
KEEP_WORDS = 1_200_000
#: Pairs of tokens whose compatibility a worker keeps, at most about twice as many.
KEEP_PAIRS = 200_000
#: White space by the Unicode property, which the tokenizer's patterns mean by \s.
SPACE = "\t-\r \x85\xa0  -     　"
_SPACES = regex.compile(f"[{SPACE}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


#: Characters that str.split() takes for white space and the pattern doesn't.
_ODD = "\x1c\x1d\x1e\x1f"


class WordBPE:
    """Encoder and decoder for a tokenizer file of this kind: NFC, white space to blanks, lower case; split by
    a pattern that leaves white space out; byte letters; BPE whose last letter carries the word-end suffix."""

    def __init__(self, path: str, keep: int = KEEP_WORDS) -> None:
        self.keep = keep
        spec = json.load(open(path, encoding="utf-8"))
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        self.split = regex.compile(pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        code = {c: i for i, c in enumerate(letters)}

        def symbols(token: str) -> str:
            """One character for each symbol: the byte, plus 256 if it carries the word end."""
            ends = token.endswith(end)
            body = [code[c] for c in (token[: -len(end)] if ends else token)]
            return "".join(map(chr, body[:-1] + [body[-1] + 256 * ends]))

        self.id = {symbols(t): i for t, i in vocab.items()}
        self.text = {i: s for s, i in self.id.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, merged id
        self.parts: dict[int, tuple[int, int, int]] = {}  # merged id -> rank, left, right
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y = vocab[a], vocab[b]
            z = self.id[self.text[x] + self.text[y]]
            self.rank.setdefault((x, y), (r, z))
            self.parts.setdefault(z, (r, x, y))
        self.auto = ahocorasick.Automaton()
        for s, i in self.id.items():
            if len(s) == 1 or i in self.parts and self._compatible(*self.parts[i][1:], self.parts[i][0]):
                self.auto.add_word(s, (len(s), i))
        self.auto.make_automaton()
        # the next shorter match from the same place: the longest proper prefix of a token that is a token
        self.shorter: dict[int, tuple[int, int] | None] = {}
        for s, (_, i) in self.auto.items():
            cut = next((k for k in range(len(s) - 1, 0, -1) if s[:k] in self.auto), 0)
            self.shorter[i] = (cut, self.id[s[:cut]]) if cut else None
        # decoding: all token strings, each with the blank that the decoder puts between tokens, and offsets
        size = max([*vocab.values(), *self.special.values()]) + 1
        strings = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            strings[i] = t.encode() + b" "
        self.width = np.array([len(s) for s in strings], dtype=np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self._reset()

    def _reset(self) -> None:
        self.seen = Recent(self.chunk, self.keep)  # ids of runs of text
        self.known: dict[int, bool] = {}  # the pair-compatibility table, filled as pairs are met
        self.older: dict[int, bool] = {}  # what it held before it last grew too large

    def _compatible(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether tokens a, b can stand side by side: no merge across their border comes before the merges
        that made them. ``below``: ranks from here on don't count (used for the halves of a token)."""
        limit = 1 << 60 if below is None else below
        while True:
            got = self.rank.get((a, b))
            if got and got[0] < limit:
                return False
            ra, rb = self.parts.get(a, (-1,))[0], self.parts.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            # undo the later of the two merges; a border merge must have come before it to matter:
            # merges of equal rank go from left to right, so before the right token's but after the left one's
            if ra > rb:
                limit, a = min(limit, ra), self.parts[a][2]
            else:
                limit, b = min(limit, rb + 1), self.parts[b][1]

    def word(self, symbols: str) -> list[int]:
        """Ids of one word, given as symbols."""
        n, shorter, known = len(symbols), self.shorter, self.known
        longest: list = [None] * n
        for end, match in self.auto.iter(symbols):  # by end, so the last match from a place is its longest
            longest[end + 1 - match[0]] = match
        out: list[int] = []
        sizes: list[int] = []
        dead: set[int] = set()
        place, match, last = 0, longest[0], -1
        while True:
            size, token = match
            end = place + size
            if end not in dead:
                fits = last < 0 or known.get(last << 20 | token)
                if fits is None:
                    fits = self.older.get(last << 20 | token)
                    known[last << 20 | token] = fits = self._compatible(last, token) if fits is None else fits
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    sizes.append(size)
                    place, match, last = end, longest[end], token
                    continue
            match = shorter[token]
            while match is None:  # nothing fits here: give the place up and shorten the token before
                dead.add(place)
                place -= sizes.pop()
                match = shorter[out.pop()]
                last = out[-1] if out else -1

    def chunk(self, run: str) -> bytes:
        """Ids (little-endian uint32) of a run of text without white space, already normalised."""
        if not run.isascii() or not run.isalpha():
            words = self.split.findall(run)
            if len(words) != 1 or words[0] != run:
                return b"".join([self.seen[w] for w in words])  # a word by itself is one word again
        b = run.encode()
        return array("I", self.word(b[:-1].decode("latin-1") + chr(256 + b[-1]))).tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text that holds no special token."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no rule for a final sigma
        if any(c in text for c in _ODD):
            runs = _SPACES.sub(" ", text).lower().split(" ")
        else:
            runs = text.lower().split()
        return b"".join(map(self.seen.__getitem__, runs))

    def encode(self, text: str) -> np.ndarray:
        """Ids (uint32) of a whole text; strings of special tokens in it become these tokens."""
        self.seen.turn()
        if len(self.known) > KEEP_PAIRS:
            self.older, self.known = self.known, {}
        if self.cut is None or not any(s in text for s in self.special):
            ids = self._plain(text)
        else:
            ids = b"".join(np.array([self.special[x]], dtype="<u4").tobytes() if x in self.special else self._plain(x)
                           for x in self.cut.split(text))
        return np.frombuffer(ids, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text: token strings from the offset table, a blank between them."""
        if not len(ids):
            return b""
        width = self.width[ids]
        ends = np.cumsum(width)
        where = np.arange(ends[-1]) + np.repeat(self.offset[ids] - (ends - width), width)
        return self.flat[where[:-1]].tobytes()


def word_bpe(path: str, keep: int = KEEP_WORDS) -> WordBPE:
    """One encoder for a worker process; the file must be at the same path on every executor. ``keep``: words whose ids
    it remembers (about 200 bytes each, at most twice as many); fewer cost time, not results."""
    at_work("bpe", _word_bpe.cache_clear)
    return _word_bpe(path, keep)


@functools.lru_cache(1)
def _word_bpe(path: str, keep: int) -> WordBPE:
    return WordBPE(path, keep)
