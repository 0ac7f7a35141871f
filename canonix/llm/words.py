"""Words and n-grams of whole texts as numpy arrays, and Arrow batch helpers for ``mapInArrow``.

Works on UTF-8 bytes: every word class used here is closed under bytes (ASCII classes plus all
non-ASCII bytes), so byte-level splitting equals the regular expressions the operators name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_MUL = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64


def space_separated() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, bool)
    t[[32, *range(9, 14)]] = False
    return t


def alphanumeric() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of text whose A-Z are lowered."""
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = t[128:] = True
    return t


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    up = (data >= 65) & (data <= 90)
    return np.where(up, data + np.uint8(32), data)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def text_slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text (one longer text is a slice of its own)."""
    for b in batches:
        if not b.num_rows:
            continue
        off = offsets_of(b.column(column))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def offsets_of(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string column's rows."""
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of a string column; null reads as empty."""
    if col.null_count:
        col = col.fill_null("")
    off = offsets_of(col)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte) of every word and, for each row, the index of its first word (plus the total)."""
    inside = word_byte[data]
    start, end = inside.copy(), inside.copy()
    if len(data):
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = off[(off > 0) & (off < len(data))]
        start[edge] = inside[edge]
        end[edge - 1] = inside[edge - 1]
    ws, we = np.flatnonzero(start), np.flatnonzero(end) + 1
    return ws, we, np.searchsorted(ws, off, side="left")


def word_hashes(data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of every word, the same in every process."""
    n = we - ws
    h = np.full(len(ws), 0x51ED270B, np.uint64)
    live, at = np.flatnonzero(n > 0), ws
    for k in range(int(min(n.max(initial=0), _LONG_WORD))):
        if k:
            live = live[n[live] > k]
        h[live] = (h[live] ^ data[at[live] + k]) * _MUL
        h[live] ^= h[live] >> np.uint64(31)
    for i in np.flatnonzero(n > _LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[ws[i]:we[i]].tobytes(), digest_size=8).digest(), "little")
    return mixed(h + n.astype(np.uint64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the ``n`` consecutive words from each position that has them (rows not regarded)."""
    m = max(0, len(h) - n + 1)
    g = h[:m].copy()
    for j in range(1, n):
        g = mixed(g * _MUL + h[j:j + m])
    return g


def inside_rows(first: np.ndarray, n: int) -> np.ndarray:
    """Positions whose ``n`` words all lie in one row; ``first`` as from ``word_spans``."""
    total = int(first[-1])
    ok = np.ones(max(0, total - n + 1), bool)
    for j in range(1, n):
        edge = first[1:-1] - j
        edge = edge[(edge >= 0) & (edge < len(ok))]
        ok[edge] = False
    return np.flatnonzero(ok)


def row_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row of each word position."""
    return np.searchsorted(first, at, side="right") - 1


def covered(starts: np.ndarray, n: int | np.ndarray, total: int) -> np.ndarray:
    """Words within any of the windows of ``n`` words that begin at ``starts``."""
    d = np.zeros(total + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + n, -1)
    return np.cumsum(d[:-1]) > 0
