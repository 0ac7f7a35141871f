"""Byte-level BPE by prefix dynamic programming.

For a rank vocabulary every byte prefix of a piece has exactly one *last token* with which its
encoding can end: the token ``t`` ending there such that BPE keeps ``t`` apart from the last token of
the prefix before ``t``. Whether two adjacent tokens stay apart follows from undoing their merges
from the latest to the earliest and looking for a merge across the seam that would have come first.
Storing the last token of each prefix gives linear-time encoding, exact appends (earlier entries
never change) and re-encoding near an edit (entries follow from at most the longest token's bytes
before them, so the old table holds again once that many entries agree).

Text is split by the tokenizer's pattern and each match is encoded by itself. Defined results: null
text is empty and has no tokens; bytes without a token cannot occur as all 256 are in the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries that a worker's caches hold before they start anew.
CACHE_ENTRIES = 400_000
#: Longer pieces are encoded one by one and not kept in a cache.
BATCH_BYTES = 48
#: The table of token pairs seen has two to this power places.
PAIR_BITS = 20


def vocabulary(path: str) -> dict:
    """Plain tables of a rank file, for a broadcast: ranks, tokens, the two halves of each token's merge."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    return tables_of(ranks)


def tables_of(ranks: dict[bytes, int]) -> dict:
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    halves: list[tuple[int, int] | None] = [None] * len(tokens)
    starts = {t[:k]: -1 for t in ranks for k in range(1, len(t))} | ranks
    out = {"ranks": ranks, "tokens": tokens, "halves": halves, "merges": {}, "starts": starts,
           "longest": max(map(len, ranks))}
    # In order of rank: encoded with earlier merges only, a token is the two halves of its own merge.
    for r in sorted(ranks.values()):
        t = tokens[r]
        if len(t) > 1:
            ids = PrefixTable(out, t, below=r).ids()
            if len(ids) == 2:
                halves[r] = (ids[0], ids[1])
                out["merges"][ids[0], ids[1]] = r
    return out


def stays_apart(vocab: dict, left: int, right: int) -> bool:
    """Whether BPE leaves these two adjacent tokens as they are."""
    merges, halves = vocab["merges"], vocab["halves"]
    bound = sys.maxsize  # merges across the seam count only if earlier than what was undone last
    while True:
        if merges.get((left, right), sys.maxsize) < bound:
            return False
        # Undo the later of the two merges; the half at the seam remains.
        if left > right:
            if halves[left] is not None:
                bound, left = left, halves[left][1]
            elif halves[right] is not None:
                bound, right = right + 1, halves[right][0]
            else:
                return True
        elif halves[right] is not None:
            bound, right = right + 1, halves[right][0]
        elif halves[left] is not None:
            bound, left = left, halves[left][1]
        else:
            return True


class PrefixTable:
    """The last token of each byte prefix of one piece."""

    def __init__(self, vocab: dict, data: bytes = b"", below: int = sys.maxsize, apart: dict | None = None):
        self.vocab, self.data, self.last = vocab, b"", []
        self.below = below  # only tokens under this rank
        self.apart = {} if apart is None else apart
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the piece; entries so far stay."""
        self.data += more
        self._fill(len(self.data))

    def _fill(self, stop: int) -> None:
        """Entries for the prefixes up to ``stop`` bytes, from tokens in order of their first byte."""
        starts, longest, apart = self.vocab["starts"], self.vocab["longest"], self.apart
        data, last, below, known = self.data, self.last, self.below, len(self.last)
        last.extend([-1] * (stop - known))
        for begin in range(max(0, known - longest + 1), stop):
            before = last[begin - 1] if begin else -1
            for end in range(max(begin, known) + 1, min(stop, begin + longest) + 1):
                t = starts.get(data[begin:end])
                if t is None:  # no token begins like this
                    break
                if t < 0 or t >= below:
                    continue
                if begin:
                    ok = apart.get((before, t))
                    if ok is None:
                        ok = apart[before, t] = stays_apart(self.vocab, before, t)
                    if not ok:
                        continue
                last[end - 1] = t

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace bytes ``start:stop``; the number of entries that were computed anew."""
        old, longest = self.last[stop:], self.vocab["longest"]
        self.data, self.last = self.data[:start] + new + self.data[stop:], self.last[:start]
        self._fill(start + len(new))
        at = 0
        while at < len(old):
            self._fill(min(len(self.data), len(self.last) + longest))
            part = old[at:at + longest]
            at += len(part)
            if self.last[-len(part):] == part and len(part) == longest:
                break  # entries depend on no more than these
        done = len(self.last) - start
        self.last += old[at:]
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(t := self.last[end - 1])
            end -= len(self.vocab["tokens"][t])
        return out[::-1]


def batch_tables(vocab: dict) -> dict:
    """``vocab`` with numpy tables for ``encode_many``: edges of the tree of token starts, and the token at each node."""
    node = {s: i + 1 for i, s in enumerate(vocab["starts"])}
    node[b""] = 0
    edges = np.array([node[s[:-1]] * 256 + s[-1] for s in vocab["starts"]], np.int64)
    order = np.argsort(edges)
    token = np.array([-1, *vocab["starts"].values()], np.int64)
    size = np.array([len(t) for t in vocab["tokens"]], np.int64)
    return vocab | {"edges": edges[order], "child": order + 1, "token": token, "size": size}


class Encoder:
    """Whole texts to ids. ``vocab`` is a worker's copy; its caches live in it from task to task."""

    def __init__(self, vocab: dict, pattern: str):
        import regex

        self.vocab, self.findall = vocab, regex.compile(pattern).findall
        cache = vocab.setdefault("cache", {})
        self.pieces = cache.setdefault(pattern, {})
        if "pair" not in cache:
            cache["pair"], cache["apart"] = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.pair, self.pair_apart = cache["pair"], cache["apart"]
        # A pattern of this form never joins a word to what follows a single space or line break.
        self.by_word = r" ?\p{L}+" in pattern and r"\s+(?!\S)" in pattern

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``stays_apart`` of many pairs, by a direct-mapped table of pairs seen."""
        code = left << 20 | right
        slot = (code * 0x2545F4914F6CDD1D >> 20) & ((1 << PAIR_BITS) - 1)
        out, miss = self.pair_apart[slot], self.pair[slot] != code
        if miss.any():
            new, back = np.unique(code[miss], return_inverse=True)
            ok = np.array([stays_apart(self.vocab, c >> 20, c & 0xFFFFF) for c in new.tolist()], bool)
            out[miss] = ok[back]
            at = (new * 0x2545F4914F6CDD1D >> 20) & ((1 << PAIR_BITS) - 1)
            # Of new pairs that share a place only the first is kept.
            at, first = np.unique(at, return_index=True)
            self.pair[at], self.pair_apart[at] = new[first], ok[first]
        return out

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many short pieces: the prefix tables of all are filled together, byte by byte."""
        v = self.vocab
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-size, kind="stable")
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8).astype(np.int64)
        size = size[order]
        end = np.cumsum(size)
        begin = end - size
        last = np.full(len(data), -1, np.int64)
        for b in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -b, side="left"))  # longer than b
            at, stop, node = begin[:n] + b, end[:n], np.zeros(n, np.int64)
            before = last[at - 1] if b else None
            while len(at):
                key = node * 256 + data[at]
                i = np.searchsorted(v["edges"], key)
                i[i == len(v["edges"])] = 0
                on = v["edges"][i] == key
                node, at, stop = v["child"][i[on]], at[on], stop[on]
                before = before[on] if b else None
                t = v["token"][node]
                whole = np.flatnonzero(t >= 0)
                if b and len(whole):
                    whole = whole[self._apart(before[whole], t[whole])]
                last[at[whole]] = t[whole]
                at = at + 1
                on = at < stop
                at, stop, node = at[on], stop[on], node[on]
                before = before[on] if b else None
        # From the end: the last token of the whole, then that of what is before it.
        steps, at, live = [], end.copy(), np.arange(len(size))
        while len(live):
            t = last[at[live] - 1]
            steps.append((live, t))
            at[live] -= v["size"][t]
            live = live[at[live] > begin[live]]
        count = np.zeros(len(size), np.int64)
        for live, _ in steps:
            count[live] += 1
        stop = np.cumsum(count)
        flat = np.zeros(int(stop[-1]) if len(stop) else 0, "<u4")
        for k, (live, t) in enumerate(steps):
            flat[stop[live] - 1 - k] = t
        packed, out = flat.tobytes(), [b""] * len(words)
        for i, lo, hi in zip(order.tolist(), ((stop - count) * 4).tolist(), (stop * 4).tolist(), strict=True):
            out[i] = packed[lo:hi]
        return out

    def _fill(self, stretches: list[str]) -> dict[str, bytes]:
        """Packed ids of stretches of text that can be split by themselves."""
        out, short, owner = {}, [], []
        for s in stretches:
            found = [m.encode() for m in self.findall(s)]
            if max(map(len, found), default=0) <= BATCH_BYTES:
                short += found
                owner.append((s, len(found)))
            else:
                out[s] = b"".join(np.array(PrefixTable(self.vocab, m).ids(), "<u4").tobytes() for m in found)
        packed, at = self.encode_many(short) if short else [], 0
        for s, n in owner:
            out[s] = packed[at] if n == 1 else b"".join(packed[at:at + n])
            at += n
        return out

    def _stretches(self, text: str) -> list[str]:
        if not text:
            return []
        lines = text.split("\n")
        if not self.by_word or not all(lines) or any(" ".join(line.split()) != line for line in lines):
            return self.findall(text)  # runs of white space: matches reach over words
        out: list[str] = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            first, *rest = line.split(" ")
            out.append(first)
            out += [" " + w for w in rest]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        cuts = [self._stretches(t) for t in texts]
        pieces = self.pieces
        new = {s for cut in cuts for s in cut if s not in pieces}
        pieces.update(self._fill(list(new)))
        out = [b"".join(map(pieces.__getitem__, cut)) for cut in cuts]
        for s in [s for s in new if len(s) > BATCH_BYTES]:
            del pieces[s]
        if len(pieces) > CACHE_ENTRIES:
            pieces.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes that packed ids stand for."""
        return b"".join(map(self.vocab["tokens"].__getitem__, np.frombuffer(ids, "<u4").tolist()))


def public_vocabulary() -> tuple[str, str]:
    """(rank file, split pattern) of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, digest: str | None = None, path: str | None = None, pattern: str | None = None,
                     text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the encoding of every whole text.

    Columns of the result's names give way to it. ``digest`` None: ``ids`` (packed binary) and ``n_tokens``; "sha256": ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``, the last from decoding the ids. One pass without a shuffle. The broadcast is the
    vocabulary, whose size does not depend on the data.
    """
    spark = docs.sparkSession
    if path is None or pattern is None:
        path, pattern = public_vocabulary()
    shared = spark.sparkContext.broadcast(batch_tables(vocabulary(path)))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = part.column(part.num_columns - 1).fill_null("").to_pylist()
                ids = coder.encode(texts)
                counts = [len(x) // 4 for x in ids]
                one = [hashlib.sha256(x).hexdigest() for x in ids] if digest else ids
                two = [hashlib.sha256(coder.decode(x)).hexdigest() for x in ids] if digest else []
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                new = [pa.array(counts, pa.int64()), pa.array(one, pa.string() if digest else pa.binary())]
                new += [pa.array(two, pa.string())] if digest else []
                yield pa.RecordBatch.from_arrays(kept + new, names=names)

    out = [T.StructField("n_tokens", T.LongType())]
    out += ([T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] if digest
            else [T.StructField("ids", T.BinaryType())])
    kept = [c for c in keep if c not in {x.name for x in out}]
    # The text goes last, by position, whatever the others are called.
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`"))
    schema = T.StructType([*source.schema.fields[:-1], *out])
    names = schema.names
    return source.mapInArrow(work, schema)


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs, digest="sha256")
