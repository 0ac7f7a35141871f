"""A double-array trie over whole-number symbols, built and walked with numpy.

A state is a place in two arrays: symbol ``c`` leads from state ``s`` to ``base[s] + c`` if ``check`` there is ``s``. The
root is state 0. All phrases have the same length, so the states at that depth accept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    #: Row of the phrases that a state accepts, or -1.
    accepts: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next state of each, -1 where there is none (also for symbols below 0 and states below 0)."""
        at = self.base[states] + symbols
        good = (symbols >= 0) & (states >= 0)
        at[~good] = 0
        return np.where(good & (self.check[at] == states), at, -1)


def build(phrases: np.ndarray, symbols: int) -> DoubleArray:
    """The trie of the rows of ``phrases`` (different ones, symbols ``0 .. symbols-1``)."""
    order = np.lexsort(phrases.T[::-1])
    rows = phrases[order]
    count, depth = rows.shape
    arrays = _Arrays(symbols)
    state = np.zeros(count, np.int64)
    for d in range(depth):
        first = np.ones(count, bool)  # of each different prefix of d + 1 symbols
        first[1:] = (state[1:] != state[:-1]) | (rows[1:, d] != rows[:-1, d])
        lead = np.flatnonzero(first)
        placed = arrays.place(state[lead], rows[lead, d].astype(np.int64))
        state = placed[np.cumsum(first) - 1]
    accepts = np.full(len(arrays.check), -1, np.int32)
    accepts[state] = order
    return DoubleArray(arrays.base, arrays.check, accepts)


class _Arrays:
    def __init__(self, symbols: int):
        self.symbols = symbols
        self.base = np.zeros(1 + symbols, np.int32)
        self.check = np.full(1 + symbols, -1, np.int32)
        self.random = np.random.default_rng(1)

    def _grow(self, more: int) -> int:
        """More places; returns the lowest base that reaches only new ones."""
        old = len(self.check)
        new = old + more + self.symbols
        if new > np.iinfo(np.int32).max:
            raise ValueError("a trie has too many states; use smaller blocks of phrases")
        self.base = np.concatenate([self.base, np.zeros(new - old, np.int32)])
        self.check = np.concatenate([self.check, np.full(new - old, -1, np.int32)])
        return old

    def place(self, parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """States of all transitions (sorted by parent, then symbol); those of the root go to places 1 and on."""
        if not len(parent) or parent[-1] == 0:
            self.base[0] = 1
            self.check[1 + symbol] = 0
            return 1 + symbol
        start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        size = np.diff(np.append(start, len(parent)))
        state = np.full(len(parent), -1, np.int64)
        low = self._grow(3 * len(parent))
        # Parents with many children first, while there is room; those of a class try at once.
        kind = np.frexp(size)[1]
        for k in np.unique(kind)[::-1]:
            left, tries = np.flatnonzero(kind == k), 0
            while len(left):
                if tries == 24:
                    low, tries = self._grow(3 * int(size[left].sum())), 0
                tries += 1
                base = self.random.integers(low, len(self.check) - self.symbols + 1, len(left))
                n = size[left]
                of = np.repeat(np.arange(len(left)), n)
                at = np.repeat(start[left], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                slot = base[of] + symbol[at]
                good = self.check[slot] < 0
                _, lead = np.unique(slot, return_index=True)  # the first of those that want a place may have it
                wins = np.zeros(len(slot), bool)
                wins[lead] = True
                fits = np.ones(len(left), bool)
                fits[of[~(good & wins)]] = False
                on = fits[of]
                self.base[parent[start[left[fits]]]] = base[fits]
                self.check[slot[on]] = parent[at[on]]
                state[at[on]] = slot[on]
                left = left[~fits]
        return state
