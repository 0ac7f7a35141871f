r"""Character shingles of lines as numpy arrays: MinHash band keys and exact Jaccard similarity, as Arrow UDFs.

A shingle is hashed to 64 bits from its eight characters. A line is handled whole, in slices of about a
megabyte of lines (one longer line is a slice of its own), so memory follows the slice, not the batch. Hashing
takes an eighth of that at a time, whose arrays stay in a core's cache.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from canonix.llm.neardup import _Block
from canonix.llm.words import mixed, text_slices

SHINGLE = 8
BANDS, ROWS = 9, 4
#: Fills lines shorter than a shingle, so that such a line is one shingle.
_FILL = "\U0010FFFF"
_WEIGHTS = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
#: For each value of a signature, an odd factor and a summand.
_TURNS = np.random.default_rng(5).integers(0, 1 << 32, (BANDS * ROWS, 2), dtype=np.uint32) | np.array([1, 0], np.uint32)
_SLICE, _CACHED = 1 << 20, 1 << 17


def hashed(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (repeats included), line after line, and where each line's begin, with the end."""
    whole = [x.decode("utf-8", "replace").ljust(SHINGLE, _FILL) for x in lines.cast(pa.binary()).to_pylist()]
    lengths = np.array([len(x) for x in whole], np.int64)
    h = np.frombuffer("".join(whole).encode("utf-32-le"), "<u4").astype(np.uint64)
    inside = np.ones(len(h), bool)
    for k in range(1, SHINGLE):  # the last characters of a line begin no shingle
        inside[np.cumsum(lengths) - k] = False
    for k, w in enumerate(_WEIGHTS):  # pairs of characters, then fours, then eights
        h = h[: -(1 << k)] * w + h[1 << k:]
    return mixed(h[inside[: len(h)]]), np.concatenate([[0], np.cumsum(lengths - SHINGLE + 1)])


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each line, the least value of its hashes' upper halves under each of ``BANDS * ROWS`` functions of their own."""
    upper = (h >> np.uint64(32)).astype(np.uint32)
    turned = np.empty_like(upper)
    least = np.empty((len(first) - 1, len(_TURNS)), np.uint64)
    for p, (mul, add) in enumerate(_TURNS if len(least) else ()):
        np.add(np.multiply(upper, mul, out=turned), add, out=turned)
        least[:, p] = np.minimum.reduceat(turned, first[:-1])
    return least


def keys_of(lines: pa.Array) -> np.ndarray:
    """(lines, bands): for each band a hash of its number and its values."""
    values = signatures(*hashed(lines))
    keys = np.empty((len(values), BANDS), np.uint64)
    for b in range(BANDS):
        keys[:, b] = b + 1
        for r in range(ROWS):
            keys[:, b] = mixed(keys[:, b] * _WEIGHTS[0] + values[:, b + BANDS * r])
    return keys.view(np.int64)


def similar(x: pa.Array, y: pa.Array, threshold: float) -> list[bool]:
    """Whether the shingle sets of ``x[i]`` and ``y[i]`` have a Jaccard similarity of ``threshold`` or more."""
    # A line that several pairs of the slice name is hashed and sorted once.
    texts = pa.concat_arrays([x, y]).dictionary_encode()
    sets, at = list(_sets(texts.dictionary)), texts.indices.to_numpy()
    out = []
    for a, b in zip(at[:len(x)].tolist(), at[len(x):].tolist(), strict=True):
        a, b = sets[a], sets[b]
        small, large = sorted((len(a), len(b)))
        if small < threshold * large - 1e-9:
            out.append(False)
            continue
        both = np.sort(np.concatenate([a, b]))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        out.append(common >= threshold * (small + large - common) - 1e-9)
    return out


def band_keys() -> Callable:
    """Arrow UDF: the band keys of a line."""
    @F.arrow_udf("array<bigint>")
    def keys(lines: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([lines], names=["x"])
        found = [keys_of(s.column(0)) for s in text_slices([whole], 0, _CACHED)]
        flat = np.concatenate([k.ravel() for k in found]) if found else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat)

    return keys


def are_similar(threshold: float) -> Callable:
    """Arrow UDF: whether two lines are similar."""
    @F.arrow_udf("boolean")
    def check(x: pa.Array, y: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([x, y], names=["x", "y"])
        slices = text_slices(text_slices([whole], 0, _SLICE), 1, _SLICE)
        return pa.array([v for s in slices for v in similar(s.column(0), s.column(1), threshold)], pa.bool_())

    return check


def _sets(lines: pa.Array) -> Iterator[np.ndarray]:
    """Sorted hashes of each line's shingles without repeats."""
    whole = pa.RecordBatch.from_arrays([lines], names=["x"])
    for s in text_slices([whole], 0, _CACHED):
        h, first = hashed(s.column(0))
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            h[lo:hi].sort()
        new = np.ones(len(h), bool)  # repeats go in the whole slice at once
        np.not_equal(h[1:], h[:-1], out=new[1:])
        new[first[:-1]] = True
        h, at = h[new], np.concatenate([[0], np.cumsum(new)])[first].tolist()
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            yield h[lo:hi]


def similar_in_blocks(threshold: float) -> Callable:
    """For ``mapInArrow`` over (key, i, j, block, node, root, line) sorted by the first three: (a, b) edges of roots.

    Lines of a block meet each other if ``i = j``, else those of the other block; of each piece of work every
    line that is similar to another gives one edge, to the least line it hangs together with.
    """
    at_key = np.zeros(1, np.int64)

    def edges(held: _Block, root: dict[int, int]) -> pa.RecordBatch:
        found = {(root[node], root[least]) for node, _, least in held.links()}
        found = sorted((a, b) for a, b in found if a != b)
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, roots = None, _Block(True, threshold), {}
        for whole in batches:
            for batch in text_slices([whole], 6, _SLICE):
                places = zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True)
                for (key, i, j, block, node, root), grams in zip(places, _sets(batch.column(6)), strict=True):
                    if (key, i, j) != now:
                        yield edges(held, roots)
                        now, held, roots = (key, i, j), _Block(i == j, threshold), {}
                    held.add(node, block, at_key, grams.tobytes())
                    roots[node] = root
        yield edges(held, roots)

    return work
