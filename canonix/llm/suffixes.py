"""Suffix arrays over words (64-bit fingerprints), built and searched with numpy.

A suffix begins at a word and ends with its document; one that ends is less than any that goes on. An array is
complete: it is sorted by prefix doubling until only suffixes of the same words are level. Each round looks only
at those that are level so far and go on, so ordinary text takes as many rounds as its repeated passages ask for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from canonix.llm import words as W

#: Suffixes that begin in one array at most; a task holds about ten numbers for each while it sorts.
SHARD_WORDS = 1 << 20
_HEAD, _TABLE_BITS = 4, 24


def suffix_array(h: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All positions in order of the words from there up to ``stop`` (where the position's document ends)."""
    n, width = len(h), 1
    order = np.argsort(h, kind="stable")
    rank = np.empty(n, np.int64)
    slots, key, ended = np.arange(n), h[order], np.zeros(n, bool)
    while len(slots):
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        # Suffixes that are level have the place of the first of them, from 1 on.
        rank[order[slots]] = 1 + slots[begin][group]
        slots = slots[(np.diff(np.append(begin, len(slots))) > 1)[group] & ~ended]
        at = order[slots]
        on = at + width < stop[at]
        key = rank[at] * (n + 1) + np.where(on, rank[np.minimum(at + width, n - 1)], 0)
        turn = np.argsort(key, kind="stable")
        order[slots], key, ended = at[turn], key[turn], ~on[turn]
        width *= 2
    return order.astype(np.int32)


@dataclass
class Shard:
    """Words ``lo .. lo + len(h)`` of a slice with the sorted suffixes among them; matches that begin in the first ``own`` words are its own."""

    lo: int
    own: int
    h: np.ndarray
    stop: np.ndarray
    order: np.ndarray

    def begins(self, size: int) -> np.ndarray:
        """Table of the first bits of the fingerprints of all ``size`` consecutive words."""
        table = np.zeros(1 << _TABLE_BITS, bool)
        at = np.flatnonzero(np.arange(len(self.h)) + size <= self.stop)
        table[W.gram_hashes(self.h, size)[at] >> np.uint64(64 - _TABLE_BITS)] = True
        return table

    def ranges(self, tests: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of ``at``, first, end): where suffixes that begin as ``tests`` does at ``at``, by ``size`` words, stand in the array."""
        which = np.arange(len(at))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order))
        for j in range(size):
            value = tests[at[which] + j]
            low, high = self._edge(low, high, j, value, False), self._edge(low, high, j, value, True)
            on = low < high
            which, low, high = which[on], low[on], high[on]
        return which, low, high

    def _edge(self, low: np.ndarray, high: np.ndarray, j: int, value: np.ndarray, after: bool) -> np.ndarray:
        """Binary search within each ``low:high``, whose suffixes have the same ``j`` words, for ``value`` as the next."""
        a, b = low.copy(), high.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            at = self.order[mid].astype(np.int64)
            word = self.h[np.minimum(at + j, len(self.h) - 1)]
            before = (word <= value[live] if after else word < value[live]) | (at + j >= self.stop[at])
            a[live[before]], b[live[~before]] = mid[before] + 1, mid[~before]
            live = live[a[live] < b[live]]
        return a


def shards(h: np.ndarray, first: np.ndarray, overlap: int, limit: int = SHARD_WORDS) -> Iterator[Shard]:
    """The suffix arrays of a slice's words; ``overlap`` words after a shard are part of it too."""
    stop = np.repeat(first[1:], np.diff(first))
    for lo in range(0, len(h), limit):
        end = min(lo + limit + overlap, len(h))
        mine = np.minimum(stop[lo:end], end) - lo
        yield Shard(lo, min(limit, len(h) - lo), h[lo:end], mine, suffix_array(h[lo:end], mine))


def occurrences(shard: Shard, tests: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in the slice, index of ``at``) of every place where the ``size`` words of ``tests`` from ``at`` on stand.

    Test suffixes whose first words stand nowhere in the shard are found out by a table; the others are searched.
    """
    head = min(size, _HEAD)
    some = np.flatnonzero(shard.begins(head)[W.gram_hashes(tests, head)[at] >> np.uint64(64 - _TABLE_BITS)])
    which, low, high = shard.ranges(tests, at[some], size)
    count = high - low
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = shard.order[np.repeat(low, count) + inner].astype(np.int64)
    own = place < shard.own
    return place[own] + shard.lo, np.repeat(some[which], count)[own]
