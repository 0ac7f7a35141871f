r"""Substring dedup by super-k-mers.

A window is 13 consecutive words (``[^\x20\x09-\x0D]+``) of one document. A window's minimiser is the
least fingerprint of its 3-word grams, so equal windows have equal minimisers wherever they are.
Consecutive windows with one minimiser travel as one packed string of words to the bucket of the
minimiser; there the strings are sorted, and each distinct window gets the smallest ``doc_id`` it
occurs in. Words covered by a window that also starts in a document with a smaller id are removed;
windows are judged on the input.

A bucket is worked on in one task while its strings are few (``BUCKET_ROWS``); the strings of a larger
one leave the task as single windows, whose smallest ids are found by a map-side combined aggregate and
joined back, so that no task holds more. Defined results: null text has no words; a null id is neither
smaller nor larger than another, so rows without id keep all words and remove none; rows with equal ids do
not remove each other's words; repeated rows are alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.llm import words as W
from canonix.llm.shard import numbered
from canonix.session import scratch_path

WINDOW = 13
GRAM = 3
BUCKET_ROWS = 200_000
#: Windows in one string at most, so that periodic text gives equal pieces.
RUN = 64
#: Text that a task packs at a time.
CHUNK_BYTES = 4 << 20
_LAST = np.iinfo(np.int64).max


def super_kmers(col: pa.Array, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(row, word in row, bucket, packed words) of the runs of windows that share a minimiser."""
    data, off = W.text_bytes(col)
    sep = ~W.space_separated()
    ws, we, first = W.word_spans(data, off, ~sep)
    at = W.inside_rows(first, window)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
    # Words one space apart: of each gap only the first byte stays.
    keep = ~sep[data]
    keep[we[we < len(data)]] = True
    moved = np.concatenate([[0], np.cumsum(keep)])
    text = np.where(sep[data], np.uint8(32), data)[keep].tobytes()
    v = W.gram_hashes(W.word_hashes(data, ws, we), gram)
    low, width = v, 1
    while 2 * width <= window - gram + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = window - gram + 1 - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    if length.max() > RUN:
        pieces = -(-length // RUN)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(begin + length, pieces)
        begin = np.repeat(begin, pieces) + step * RUN
        length = np.minimum(end - begin, RUN)
    word = at[begin]
    lo, hi = moved[ws[word]], moved[we[word + length + window - 2]]
    row = W.row_of(first, word)
    return row, word - first[row], low[begin].view(np.int64), [text[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte by byte, the first bytes of all first: near numbers compress well."""
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _numbers(data: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).ravel()


def _packed(docs: DataFrame, window: int, groups: int) -> DataFrame:
    """(grp, blob): the packed strings of a stretch of rows for one group of buckets, compressed together."""

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, size = [], 0
        for b in W.text_slices(batches, 1, 1 << 20):
            held.append(b)
            size += int(np.ptp(W.offsets_of(b.column(1))[[0, -1]]))
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
        if held:
            yield held

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for chunk in chunks(batches):
            doc, row, word, bucket, packed = [], [], [], [], []
            for b in chunk:
                r, w, k, strings = super_kmers(b.column(1), window)
                doc.append(b.column(0).to_numpy()[r])
                row.append(b.column(2).to_numpy()[r])
                word.append(w)
                bucket.append(k.view(np.uint64))
                packed += strings
            chunk.clear()
            doc, row, word, bucket = (np.concatenate(x) for x in (doc, row, word, bucket))
            group = (bucket >> np.uint64(32)) % np.uint64(groups)
            order = np.lexsort([bucket, group])
            names, cut = np.unique(group[order], return_index=True)
            out = []
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True):
                i = order[lo:hi]
                out.append(squeeze.compress(b"".join([
                    len(i).to_bytes(8, "little"), _planes(bucket[i].astype("<u4")), _planes(doc[i].astype("<i8")),
                    _planes(row[i].astype("<i8")), _planes(word[i].astype("<i8")), b"\n".join([packed[j] for j in i.tolist()])])))
                for j in i.tolist():
                    packed[j] = None
                if len(out) == 64 or hi == len(order):
                    done = hi == len(order)
                    at = len(names) if done else np.searchsorted(cut, hi)
                    yield pa.RecordBatch.from_arrays([pa.array(names[at - len(out):at].astype(np.int64)), pa.array(out, pa.binary())],
                                                     names=["grp", "blob"])
                    out = []

    return docs.select(F.col("doc_id").cast("long"), "text", "__row").mapInArrow(work, "grp long, blob binary")


def _unpacked(blobs: DataFrame) -> DataFrame:
    """(bucket, packed, doc, row, word) of the blobs."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        for b in batches:
            for blob in b.column(1):
                data = expand.decompress(blob.as_py())
                n, at = int.from_bytes(data[:8], "little"), 8
                numbers = []
                for kind in ("<u4", "<i8", "<i8", "<i8"):
                    size = n * np.dtype(kind).itemsize
                    numbers.append(_numbers(data[at:at + size], n, kind).astype(np.int64))
                    at += size
                strings = data[at:].split(b"\n")
                for lo in range(0, n, 10_000):
                    part = slice(lo, lo + 10_000)
                    bucket, doc, row, word = (pa.array(x[part]) for x in numbers)
                    yield pa.RecordBatch.from_arrays([bucket, pa.array(strings[part], pa.binary()), doc, row, word],
                                                     names=["bucket", "packed", "doc", "row", "word"])

    return blobs.mapInArrow(work, "bucket long, packed binary, doc long, row long, word long")


def _cuts(packed: bytes, window: int) -> list[bytes]:
    """The windows of a packed string."""
    b = np.frombuffer(packed, np.uint8)
    space = np.flatnonzero(b == 32)
    begin = [0, *(space + 1).tolist()]
    end = [*space.tolist(), len(packed)]
    return [packed[i:j] for i, j in zip(begin, end[window - 1:], strict=False)]


class _Bucket:
    """The strings of one minimiser, as they come in order of string and document."""

    def __init__(self, window: int, limit: int):
        self.window, self.limit, self.parts, self.rows, self.over = window, limit, [], 0, False

    def add(self, packed: list[bytes], doc: np.ndarray, row: np.ndarray, word: np.ndarray) -> None:
        self.parts.append((packed, doc, row, word))
        self.rows += len(packed)

    def done(self) -> Iterator[tuple]:
        """(doc, row, word, words, None) of what to remove."""
        if self.rows < 2 or self.over and not self.rows:
            return
        packed = [p for part in self.parts for p in part[0]]
        doc, row, word = (np.concatenate([part[i] for part in self.parts]).tolist() for i in (1, 2, 3))
        if min(doc) == max(doc):
            return
        if packed[0] == packed[-1]:  # sorted: all alike, the first is the smallest document's
            n, least = packed[0].count(b" ") + 1, doc[0]
            for i in range(len(packed)):
                if doc[i] > least:
                    yield doc[i], row[i], word[i], n, None
            return
        least: dict[bytes, int] = {}
        cuts, before = [], None
        for p, d in zip(packed, doc, strict=True):
            if p != before:
                mine, before = _cuts(p, self.window), p
                for x in mine:
                    if least.get(x, _LAST) >= d:
                        least[x] = d
            cuts.append(mine)
        for i, mine in enumerate(cuts):
            d, begin = doc[i], None
            for k, x in enumerate([*mine, None]):
                hit = x is not None and least[x] < d
                if hit and begin is None:
                    begin = k
                elif not hit and begin is not None:
                    yield d, row[i], word[i] + begin, k - begin + self.window - 1, None
                    begin = None

    def spill(self) -> Iterator[tuple]:
        """The strings so far as single windows."""
        self.over = True
        for packed, doc, row, word in self.parts:
            for p, d, m, w in zip(packed, doc.tolist(), row.tolist(), word.tolist(), strict=True):
                for k, x in enumerate(_cuts(p, self.window)):
                    yield d, m, w + k, self.window, x
        self.parts, self.rows = [], 0


def repeated_stretches(docs: DataFrame, window: int = WINDOW, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc, row, word, words): stretches to remove, of ``docs`` by row number (``__row``)."""
    schema = "doc long, row long, word long, words long, window binary"
    names = ["doc", "row", "word", "words", "window"]
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for r in rows:
            held.append(r)
            if len(held) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds, strict=True)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds, strict=True)], names=names)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        now, held = None, _Bucket(window, bucket_rows)
        for b in batches:
            if not b.num_rows:
                continue
            bucket, doc, row, word = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            end = np.append(cut[1:], len(bucket))
            inner = end - cut > 1  # a string alone in its bucket has nothing to share
            inner[0] = inner[-1] = True
            for lo, hi in zip(cut[inner].tolist(), end[inner].tolist(), strict=True):
                if bucket[lo] != now:
                    yield from held.spill() if held.over else held.done()
                    now, held = int(bucket[lo]), _Bucket(window, bucket_rows)
                held.add(b.column(1).slice(lo, hi - lo).to_pylist(), doc[lo:hi], row[lo:hi], word[lo:hi])
                if held.rows > bucket_rows:
                    yield from held.spill()
        yield from held.spill() if held.over else held.done()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(rows(batches))

    groups = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _unpacked(_packed(docs, window, groups).repartition("grp")).sortWithinPartitions("bucket", "packed", "doc").mapInArrow(work, schema)
    out = scratch_path(docs.sparkSession, "repeats")
    found.write.parquet(out)
    found = docs.sparkSession.read.parquet(out)
    alone = found.filter("window IS NOT NULL")
    least = alone.groupBy("window").agg(F.min("doc").alias("least"))
    late = alone.join(least, "window").filter("doc > least")
    return found.filter("window IS NULL").drop("window").unionByName(late.select("doc", "row", "word", "words"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document's kept words, one space apart."""
    docs, _ = numbered(docs.select(F.col("doc_id").cast("long"), "text"), "__row")
    gone = repeated_stretches(docs.filter("doc_id IS NOT NULL"), window, bucket_rows)
    gone = gone.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("word", "words"))).alias("gone"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sep = ~W.space_separated()
        for b in W.text_slices(batches, 1, 1 << 20):
            data, off = W.text_bytes(b.column(1))
            ws, we, first = W.word_spans(data, off, ~sep)
            out = np.zeros(len(ws), bool)
            for r, spans in enumerate(b.column(2).to_pylist()):
                for s in spans or ():
                    out[first[r] + s["word"]:first[r] + s["word"] + s["words"]] = True
            text, kept = data.tobytes(), []
            begin, end = ws.tolist(), we.tolist()
            for r in range(b.num_rows):
                stay = np.flatnonzero(~out[first[r]:first[r + 1]]) + first[r]
                kept.append(b" ".join([text[begin[i]:end[i]] for i in stay.tolist()]))
            removed = np.concatenate([[0], np.cumsum(out)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(first)), pa.array(removed[first[1:]] - removed[first[:-1]]),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.join(gone, docs["__row"] == gone["row"], "left").select("doc_id", "text", "gone").mapInArrow(
        work, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words without those of repeated windows."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
late AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM late),
word AS (SELECT r, j, w[j] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS j FROM doc)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY j) AS s FROM word ANTI JOIN gone USING (r, j) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""
