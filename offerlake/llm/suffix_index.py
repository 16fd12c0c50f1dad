"""Sparse suffix arrays of texts, and a logarithmic family of them.

A string of ``length`` bytes holds ``length - GRAM + 1`` grams of GRAM bytes;
the one with the smallest hash, the leftmost if several, is its anchor.  Equal
strings have their anchor in the same place, so only suffixes that start at
anchors need to be indexed.  An anchor stands for a run of neighbouring
strings, its segment: the bytes from the first string's start to the last
one's end.  Suffixes are ordered by the fingerprint of their first GRAM bytes,
then by that of their segment.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

GRAM = 20
#: Strings of a text that are looked at together; a cut between two pieces costs no match.
PIECE = 1 << 20
_INDEX = np.uint64((1 << 21) - 1)

_seed = np.random.default_rng(20)
_BYTE = _seed.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2**64, for at least n places."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        _powers[:] = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def running(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``fingerprint`` takes any part's hash."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * p[: len(data)], out=out[1:])
    return out


def fingerprint(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the parts [start, end); equal parts have equal ones wherever they are."""
    _, inverse = powers(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start])


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes of a text as (gram, segment, first start, number of starts) arrays."""
    out = []
    for lo in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[lo : lo + PIECE + length - 1]
        sums = running(part)
        at = np.arange(len(part) - GRAM + 1)
        gram = fingerprint(sums, at, at + GRAM)
        best = window_min((gram & ~_INDEX) | at.astype(np.uint64), length - GRAM + 1)
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        count = np.diff(np.r_[first, len(best)])
        segment = mix(fingerprint(sums, first, first + count - 1 + length) + count.astype(np.uint64))
        out.append((gram[(best[first] & _INDEX).astype(np.int64)], segment, first + lo, count))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out))


class Run(NamedTuple):
    """A suffix array: one entry for each distinct segment, sorted by gram.

    ``both`` holds the sorted keys of (gram, segment) for look-ups and ``entry`` the
    entry of each; ``told`` marks entries that were reported already.
    """

    rank: int
    gram: np.ndarray
    segment: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    told: np.ndarray
    both: np.ndarray
    entry: np.ndarray


def key(gram: np.ndarray, segment: np.ndarray) -> np.ndarray:
    return mix(gram + mix(segment))


def repeated(level: Run, both: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys a level holds, and which of these it holds at another place."""
    known = found_in(both, level.both)
    hit = level.entry[np.searchsorted(level.both, both[known])]
    moved = known.copy()
    moved[known] = (level.doc[hit] != doc[known]) | (level.at[hit] != at[known])
    return known, moved


def found_in(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


class Family:
    """Suffix arrays of geometrically growing size over suffixes that come in text order.

    ``add`` takes the next batch and reports: ``copies``, suffixes whose segment
    occurred before, and ``open``, distinct segments that share a gram with
    another one, of which some strings may be equal.  Each segment is opened once.
    A suffix at the very place of the segment's first one is that of a repeated
    row and no copy, whether they meet in one batch or over two.
    """

    def __init__(self):
        self.levels: list[Run] = []

    def add(self, gram, segment, doc, at):
        order = np.lexsort((np.arange(len(gram)), segment, gram))
        gram, segment, doc, at = gram[order], segment[order], doc[order], at[order]
        again = np.zeros(len(gram), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (segment[1:] == segment[:-1])
        # A copy at the very place of the first one is a repeated row, not an earlier string.
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(gram))))
        same = again & (doc == doc[head]) & (at == at[head])
        both = key(gram, segment)
        known, moved = np.zeros(len(gram), bool), np.zeros(len(gram), bool)
        for level in self.levels:
            for mark, found in zip((known, moved), repeated(level, both, doc, at)):
                mark |= found
        new = ~again & ~known
        copies = (again & ~same & ~known) | moved
        result = [doc[copies], at[copies]]
        gram, segment, doc, at, both = (x[new] for x in (gram, segment, doc, at, both))
        shared = np.zeros(len(gram), bool)
        shared[1:] = gram[1:] == gram[:-1]
        shared[:-1] |= shared[1:].copy()
        opened = []
        for level in self.levels:
            lo, hi = np.searchsorted(level.gram, gram, "left"), np.searchsorted(level.gram, gram, "right")
            hit = hi > lo
            shared |= hit
            edge = np.zeros(len(level.gram) + 1, np.int64)
            np.add.at(edge, lo[hit], 1)
            np.add.at(edge, hi[hit], -1)
            tell = (np.cumsum(edge[:-1]) > 0) & ~level.told
            level.told[tell] = True
            opened.append((level.gram[tell], level.doc[tell], level.at[tell]))
        opened.append((gram[shared], doc[shared], at[shared]))
        entry = np.argsort(both, kind="stable")
        self._push(Run(0, gram, segment, doc, at, shared, both[entry], entry))
        return result, [np.concatenate(x) for x in zip(*opened)]

    def _push(self, run: Run) -> None:
        while self.levels and self.levels[-1].rank == run.rank:
            run = merge(self.levels.pop(), run)
        self.levels.append(run)


def merge(a: Run, b: Run) -> Run:
    """Two suffix arrays of equal rank as one of the next; their segments are distinct."""
    order = np.argsort(np.concatenate([a.gram, b.gram]), kind="stable")  # two runs: a linear merge
    parts = [np.concatenate([getattr(a, f), getattr(b, f)])[order] for f in ("gram", "segment", "doc", "at", "told")]
    now = np.empty(len(order), np.int64)
    now[order] = np.arange(len(order))
    both, entry = np.concatenate([a.both, b.both]), now[np.concatenate([a.entry, b.entry + len(a.gram)])]
    order = np.argsort(both, kind="stable")
    return Run(a.rank + 1, *parts, both[order], entry[order])
