"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Round t inserts, for every string that has t symbols, its suffix of t symbols: the symbol in front of the
suffix of the last round is set in the transform, the place of the new suffix follows by counting symbols
before it, and its common prefix with its neighbours by the minimum between two equal symbols. The
transform, the common prefixes and the owners are sequences that each round reads and writes once from front to end.
"""

from __future__ import annotations

import numpy as np


def suffixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, size, common) of all suffixes in order: owner, length, and prefix shared with the one before (at most ``cap``).

    Strings end with marks that differ, in the order of the strings; the marks are not part of the result."""
    m = len(starts)
    letters, code = np.unique(data, return_inverse=True)
    code = code.astype(np.uint8)
    small = np.uint8 if cap < 255 else np.uint16 if cap < 65535 else np.uint32
    longest = int(sizes.max(initial=0))
    wide = np.uint32 if m < 1 << 16 and longest < 1 << 16 else np.uint64  # owner and size of a suffix together
    shift, low = (wide(16), wide(0xFFFF)) if wide is np.uint32 else (wide(32), wide(0xFFFFFFFF))
    ends = starts + sizes
    # the suffixes so far, the empty ones first, and the transform as the places of each symbol, symbol by symbol:
    # entry k leads from the suffix at that place to suffix m + k, which has the symbol in front of it
    common, tag = np.zeros(m, small), np.arange(m, dtype=wide) << shift
    places, counts = np.zeros(0, np.int32), np.zeros(len(letters), np.int64)
    at = own = np.arange(m, dtype=np.int32)  # places and owners of the suffixes of the last round
    for t in range(1, longest + 1):
        on = sizes[own] >= t
        at, own = at[on], own[on]
        c = code[ends[own] - t]
        turn = np.argsort(c, kind="stable")  # the places ascend already
        at, own, c = at[turn], own[turn], c[turn]
        # where the new symbols come in among the equal ones
        begin = np.concatenate([[0], np.cumsum(counts)])
        rank = np.arange(len(at), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            first = begin[c[lo]]
            rank[lo:hi] += first + np.searchsorted(places[first : begin[c[lo] + 1]], at[lo:hi])
        counts += np.bincount(c, minlength=len(counts))
        rank_end = np.cumsum(counts)
        old = np.ones(len(places) + len(at), bool)
        old[rank] = False
        joined = np.empty(len(old), np.int32)
        joined[old], joined[rank] = places, at
        # common prefixes that the insertions change: of a new suffix and of the one behind it
        mark = np.zeros(len(old) + 1, bool)
        mark[rank] = mark[rank + 1] = True
        ask = np.flatnonzero(mark[:-1])
        mark[:] = False
        mark[0] = mark[rank_end] = True  # where a symbol's entries begin
        back = ask[~mark[ask]][::-1]  # falling places make what lies between the asked empty
        pairs = np.stack([joined[back - 1] + 1, joined[back] + 1], axis=1).ravel()
        least = np.minimum.reduceat(np.append(common, small(0)), pairs)[::2] if len(back) else common[:0]
        stay = np.flatnonzero(old)
        grown = []
        for a, fill in ((common, 0), (tag, own.astype(wide) << shift | wide(t))):
            out = np.empty(m + len(old), a.dtype)
            out[:m] = a[:m]
            body = out[m:]
            body[old], body[rank] = a[m:], fill
            grown.append(out)
        common, tag = grown
        common[m + ask] = 0
        common[m + back] = np.minimum(least.astype(np.int64) + 1, cap)
        places = np.concatenate([np.arange(m, dtype=np.int32), (m + stay).astype(np.int32)])[joined]
        at = (m + rank).astype(np.int32)
    return (tag[m:] >> shift).astype(np.int64), (tag[m:] & low).astype(np.int64), common[m:]


def later_windows(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """For every string a bit mask of the places (under 64) where a string of ``length`` bytes begins that also begins
    in a string of lower rank. No window may be twice in a string."""
    owner, size, common = suffixes(data, starts, sizes, length)
    full = size >= length
    group = np.cumsum((common < length)[full] if full.all() else _breaks(common, full, length))
    owner, place = owner[full], (sizes[owner] - size)[full]
    mask = np.zeros(len(starts), np.uint64)
    if len(owner):
        first = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, group, rank[owner])
        later = rank[owner] > first[group]
        np.bitwise_or.at(mask, owner[later], np.uint64(1) << place[later].astype(np.uint64))
    return mask


def _breaks(common: np.ndarray, full: np.ndarray, length: int) -> np.ndarray:
    """Whether each full suffix begins a group: some prefix since the full one before is shorter than the window."""
    short = np.cumsum(common < length)
    at = short[full]
    return np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
