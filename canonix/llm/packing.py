"""Token-ID output: documents packed into rows of fixed length.

Every document becomes its token ids and an end token. A document longer than a row is split without
loss into whole rows and a rest; rests and short documents are packed best-fit decreasing: longest
first, each into the row with the least room that still holds it, found by a segment tree over the
amounts of room. A packed row has the id matrix line (``input_ids``, little-endian unsigned 16- or
32-bit, padded with the end token), the cumulative segment lengths (``cu_seqlens``, from 0) and the
positions (``position_ids``, which begin anew with each segment; padding counts as a last segment
that ``cu_seqlens`` leaves out).

``write_packed`` puts them as files into a shared folder, each task its own shard under a name of its
attempt: ``input_ids`` and ``position_ids`` are matrices of one line after the other, ``cu_seqlens`` is
the 32-bit lengths of one line after the other (each from 0), ``segments.parquet`` the documents and
pieces of each line. The manifest lists the attempts that Spark's committer took; files of others are
never read. The folder has to be in a store that pyarrow opens (local or shared files, HDFS, S3, GCS).

Packing is done by stretches of ``STRETCH_TOKENS`` tokens within a task, so memory is bounded and
nothing is shuffled; at most the last rows of a stretch stay partly empty. Defined results: null or
empty text is the end token alone; repeated documents are packed each; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.llm.bpe import Encoder, batch_tables, public_vocabulary, vocabulary
from canonix.session import scratch_path

ROW = 2048
STRETCH_TOKENS = 2_000_000
#: The tiktoken library encodes texts up to this length; longer ones are encoded by prefix tables in linear time.
LONG_TEXT = 200_000
#: Lines that are written and read at a time.
_BATCH = 256
_MANIFEST = "shard int, folder string, lines long, width int, kind string"
_SCHEMA = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("line", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("pieces", T.ArrayType(T.IntegerType())),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("input_ids", T.BinaryType()),
    T.StructField("position_ids", T.BinaryType())])


class RoomTree:
    """Rows by the room they have left: a segment tree over 0 .. capacity says which amounts occur."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``need``; None if there is none."""
        i, count = need + self.size, self.count
        while not count[i]:  # up, and to the right, until amounts at or above ``need`` occur
            while i & 1:
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by row, best-fit decreasing; sizes are 1 .. capacity."""
    tree, rows = RoomTree(capacity), []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = tree.take(size)
        if found is None:
            rows.append([item])
            room, row = capacity - size, len(rows) - 1
        else:
            rows[found[1]].append(item)
            room, row = found[0] - size, found[1]
        if room:
            tree.put(room, row)
    return rows


def _pieces(tokens: list[np.ndarray], capacity: int) -> list[tuple[int, int, np.ndarray]]:
    """(document, number of its piece, ids): documents cut at multiples of the row length."""
    return [(d, k, ids[lo:lo + capacity]) for d, ids in enumerate(tokens)
            for k, lo in enumerate(range(0, len(ids), capacity))]


def _packed_rows(ids: list, tokens: list[np.ndarray], capacity: int, end: int, kind: str) -> Iterator[tuple]:
    pieces = _pieces(tokens, capacity)
    for items in best_fit(np.array([len(p[2]) for p in pieces], np.int64), capacity):
        cu = np.concatenate([[0], np.cumsum([len(pieces[i][2]) for i in items])])
        line = np.full(capacity, end, kind)
        line[:cu[-1]] = np.concatenate([pieces[i][2] for i in items])
        begin = np.repeat(np.append(cu[:-1], cu[-1]), np.append(np.diff(cu), capacity - cu[-1]))
        yield ([ids[pieces[i][0]] for i in items], [pieces[i][1] for i in items], cu.tolist(), line.tobytes(),
               (np.arange(capacity) - begin).astype(kind).tobytes())


def _packer(spark: SparkSession, row: int = ROW, path: str | None = None, pattern: str | None = None,
            end_token: int = 50256, stretch: int = STRETCH_TOKENS) -> Callable:
    """For ``mapInArrow`` over (doc_id, text): the packed lines."""
    if path is None or pattern is None:
        path, pattern = public_vocabulary()
    # The vocabulary's size does not depend on the data.
    shared = spark.sparkContext.broadcast(batch_tables(vocabulary(path)))
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = _SCHEMA.names

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        vocab = shared.value
        coder = Encoder(vocab, pattern)
        quick = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocab["ranks"], special_tokens={})
        kind = "<u2" if max(len(vocab["tokens"]) - 1, end_token, row - 1) < 1 << 16 else "<u4"
        shard, line = TaskContext.get().partitionId(), 0
        ids, tokens, size = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal line
            held = []
            for r in _packed_rows(ids, tokens, row, end_token, kind):
                held.append((shard, line, *r))
                line += 1
                if len(held) == _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds, strict=True)], names=names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds, strict=True)], names=names)

        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py() or ""
                got = (np.array(quick.encode_ordinary(text), "<u4") if len(text) <= LONG_TEXT
                       else np.frombuffer(coder.encode([text])[0], "<u4"))
                ids.append(doc.as_py())
                tokens.append(np.append(got, end_token).astype("<u4"))
                size += len(got) + 1
                if size >= stretch:
                    yield from out()
                    ids, tokens, size = [], [], 0
        if ids:
            yield from out()

    return work


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def pack_documents(docs: DataFrame, row: int = ROW, **options) -> DataFrame:
    """One row for each packed line: shard, line, doc_ids, pieces, cu_seqlens, input_ids, position_ids."""
    return _documents(docs).mapInArrow(_packer(docs.sparkSession, row, **options), _SCHEMA)


def write_packed(docs: DataFrame, out: str, row: int = ROW, **options) -> DataFrame:
    """The packed lines of ``docs`` as files in the shared folder ``out``; returns the manifest, one row for each shard."""
    pack = _packer(docs.sparkSession, row, **options)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        folder = f"{out}/shard-{task.partitionId():05d}-{task.taskAttemptId()}"
        files, lines, width = {}, 0, 0
        with ExitStack() as opened:
            for b in pack(batches):
                segments = b.select(["doc_ids", "pieces"])
                if not files:
                    fs, at = FileSystem.from_uri(folder)
                    fs.create_dir(at)
                    for name in ("input_ids", "position_ids", "cu_seqlens", "segments.parquet"):
                        files[name] = opened.enter_context(fs.open_output_stream(f"{at}/{name}"))
                    table = opened.enter_context(pq.ParquetWriter(files["segments.parquet"], segments.schema))
                for name in ("input_ids", "position_ids"):
                    for line in b.column(name):
                        files[name].write(line.as_buffer())
                files["cu_seqlens"].write(b.column("cu_seqlens").flatten().to_numpy().astype("<i4").tobytes())
                table.write_batch(segments)
                lines, width = lines + b.num_rows, len(b.column("input_ids")[0].as_buffer())
        if lines:
            one = [(task.partitionId(), pa.int32()), (folder, pa.string()), (lines, pa.int64()), (row, pa.int32()), (f"<u{width // row}", pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in one], names=["shard", "folder", "lines", "width", "kind"])

    _documents(docs).mapInArrow(work, _MANIFEST).write.parquet(f"{out}/manifest")
    return docs.sparkSession.read.schema(_MANIFEST).parquet(f"{out}/manifest")


def _whole(file: pa.NativeFile, size: int) -> pa.Buffer:
    got = file.read_buffer(size)
    if len(got) != size:
        raise OSError(f"a packed file ends {size - len(got)} bytes early")
    return got


def read_packed(manifest: DataFrame) -> DataFrame:
    """The rows of ``pack_documents``, read from the files that the manifest lists."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in (r for b in batches for r in b.to_pylist()):
            fs, at = FileSystem.from_uri(shard["folder"])
            size, done = shard["width"] * np.dtype(shard["kind"]).itemsize, 0
            with ExitStack() as opened:
                files = {n: opened.enter_context(fs.open_input_stream(f"{at}/{n}")) for n in ("input_ids", "position_ids", "cu_seqlens")}
                table = pq.ParquetFile(opened.enter_context(fs.open_input_file(f"{at}/segments.parquet")))
                for s in table.iter_batches(_BATCH):
                    n = s.num_rows
                    first = np.concatenate([[0], np.cumsum(s.column("pieces").value_lengths().to_numpy() + 1)]).astype(np.int32)
                    cu = np.frombuffer(_whole(files["cu_seqlens"], 4 * int(first[-1])), "<i4")
                    lines = [pa.Array.from_buffers(pa.binary(size), n, [None, _whole(files[c], n * size)]).cast(pa.binary())
                             for c in ("input_ids", "position_ids")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard["shard"], np.int32)), pa.array(np.arange(done, done + n)), *s.columns,
                         pa.ListArray.from_arrays(first, cu), *lines], names=_SCHEMA.names)
                    done += n
            if done != shard["lines"]:
                raise OSError(f"{shard['folder']} has {done} of {shard['lines']} lines")

    # A task for each shard: the manifest is small, the shards are not.
    return manifest.repartition(max(1, manifest.count())).mapInArrow(work, _SCHEMA)


def op4_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed lines of 2,048 tokens, written to files of the shared folder and read from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_packed(write_packed(docs, scratch_path(spark, "packed-tokens")))
