"""Suffix arrays against sorting by whole suffixes, and searches against looking everywhere."""

import numpy as np
import pytest

from canonix.llm import suffixes


def _slice(seed, sizes, words):
    rng = np.random.default_rng(seed)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return rng.integers(0, words, first[-1]).astype(np.uint64) << np.uint64(60), first


CASES = [(1, [0, 5, 1, 0, 40, 7], 2), (2, [200], 1), (3, [30] * 6, 3), (4, [], 2), (5, [1], 2), (6, [64, 64, 3], 15)]


@pytest.mark.parametrize("seed,sizes,words", CASES)
def test_order_is_that_of_whole_suffixes(seed, sizes, words):
    h, first = _slice(seed, sizes, words)
    h = np.concatenate([h, h])  # every document twice
    first = np.concatenate([first, first[1:] + first[-1]])
    stop = np.repeat(first[1:], np.diff(first))
    order = suffixes.suffix_array(h, stop)
    suffix = [tuple(h[i:stop[i]].tolist()) for i in range(len(h))]
    assert sorted(order.tolist()) == list(range(len(h)))
    assert [suffix[i] for i in order] == sorted(suffix)


@pytest.mark.parametrize("limit", [1 << 20, 16, 1])
@pytest.mark.parametrize("seed,sizes,words", CASES)
def test_every_place_is_found_once(seed, sizes, words, limit):
    h, first = _slice(seed, sizes, words)
    stop = np.repeat(first[1:], np.diff(first))
    tests = np.random.default_rng(9).integers(0, words, 50).astype(np.uint64) << np.uint64(60)
    for size in (1, 3, 6):
        at = np.arange(0, 50 - size, 2)
        found = [suffixes.occurrences(s, tests, at, size) for s in suffixes.shards(h, first, 5, limit)]
        got = [(int(p), int(w)) for places, which in found for p, w in zip(places, which, strict=True)]
        want = [(p, w) for p in range(len(h)) for w, t in enumerate(at) if p + size <= stop[p] and (h[p:p + size] == tests[t:t + size]).all()]
        assert sorted(got) == want
