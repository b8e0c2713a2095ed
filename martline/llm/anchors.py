"""Cutting of texts into pieces by anchors, so that equal strings of a fixed length meet under the same anchor.

A window (a string of ``length`` bytes) has as its anchor the ``gram``-byte string in it with the smallest hash, the
leftmost of several. Equal windows have equal anchors. Consecutive windows with the same anchor at the same place are one
piece: at most length - gram + 1 windows, so at most 2 * length - gram bytes. No window is twice in one piece.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: A place in a buffer has to fit the low bits of a key.
_PLACE = 22


@functools.lru_cache(1)
def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(1 << _PLACE, _BASE)]))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at each place of the buffer."""
    power = _powers()
    n = len(data)
    with np.errstate(over="ignore"):
        total = data.astype(np.uint64)
        total += np.uint64(1)
        total *= power[:n]
        np.cumsum(total, out=total)
        h = total[gram - 1 :].copy()
        h[1:] -= total[: n - gram]
        top = 1 << _PLACE
        h *= power[top - (n - gram) : top + 1][::-1]  # all to one power
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def pieces(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, windows) of every piece of a buffer of documents that end at ``ends``, by start."""
    step = (1 << _PLACE) - 2 * length
    if len(data) <= step:
        return _pieces(data, ends, length, gram)
    found = []  # a very long buffer: parts that overlap by a window less one byte; a cut in a piece makes two of it
    for at in range(0, len(data), step):
        stop = min(len(data), at + step + length - 1)
        inner = ends[(ends > at) & (ends < stop)]
        a, s, w = _pieces(data[at:stop], np.append(inner, stop) - at, length, gram)
        found.append((a, s + at, w))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pieces(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) < length:
        return none
    h = gram_hashes(data, gram)
    key = h >> np.uint64(_PLACE)
    key <<= np.uint64(_PLACE)
    key |= np.arange(len(h), dtype=np.uint64)
    low = sliding_min(key, length - gram + 1)
    low &= np.uint64((1 << _PLACE) - 1)
    at = low.astype(np.uint32)
    # windows that stay within their document; a piece ends where they do, or where the anchor changes
    edge = np.ones(len(at) + 1, bool)
    np.not_equal(at[1:], at[:-1], out=edge[1:-1])
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(at) + 1, np.int8)
    real = ends - begins >= length
    np.add.at(inside, begins[real], 1)
    np.add.at(inside, ends[real] - length + 1, -1)
    ok = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    edge[begins[real]] = edge[ends[real] - length + 1] = True
    starts = np.flatnonzero(edge[:-1] & ok)
    stops = np.flatnonzero(edge[1:] & ok)
    return h[at[starts]], starts, stops - starts + 1
