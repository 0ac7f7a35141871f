r"""Importance resampling towards a target distribution, by features from an overlapped regex scan.

A-Z are lowered, every run of separators becomes one space, and ``regex.finditer(overlapped=True)`` with lookarounds
at word boundaries gives the spans of all runs of ``1 .. n`` words; a feature's bucket is the CRC-32 of its
bytes modulo ``buckets``. Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``; a class of bytes, as all separators
are ASCII, so texts are scanned as UTF-8.

Texts are scanned once: each text's buckets are written to the shared folder (2 bytes a feature, or 4), then counted
and weighed from there. A bucket's gain is ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))`` with s of S
features of all documents and t of T of the target; a document's weight is the floored mean of its features'
gains. To it comes Gumbel noise that follows from the id; of the N documents with at least ``least_words`` words
the ``N * percent / 100`` of highest score are drawn. The rank is the place in the sorted, written table (``places.py``).

Bounds: the driver and each task hold ``buckets`` counts and gains, whatever the input. Defined results: null and empty texts have no features
and weight 0; a null id reads as empty in the noise and stands last among equals; repeated rows are different
rows, in any order; with an empty target T and t are 0; an empty table gives no rows. Long texts are scanned whole. Input columns named like a
result column give way to it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.llm import words as W
from canonix.llm.places import placed, written

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
_RESULT = ("n_features", "weight", "score", "rank")
_ONE_SPACE = bytes(b if W.alphanumeric()[b] else 32 for b in (c + 32 if 65 <= c <= 90 else c for c in range(256)))
_SPACES = regex.compile(rb" {2,}")


def _pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words of text with single spaces, from one word's first byte to another's last."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?![^ ])")


def feature_buckets(text: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """(words, bucket of every feature) of a text."""
    text = _SPACES.sub(b" ", text.translate(_ONE_SPACE))
    found = [np.fromiter(map(zlib.crc32, map(itemgetter(0), p.finditer(text, overlapped=True))), np.uint32) for p in patterns]
    return len(found[0]), np.concatenate(found) % np.uint32(buckets)


def _kind(buckets: int) -> np.dtype:
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def scanned(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """``texts`` (last column: text) with ``words`` and ``buckets`` (packed) instead of the text."""
    patterns, kind, last = [_pattern(i + 1) for i in range(n)], _kind(buckets), len(texts.columns) - 1
    schema = T.StructType([*texts.schema.fields[:-1], T.StructField("words", T.LongType()), T.StructField("buckets", T.BinaryType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.text_slices(batches, last):
            data, off = W.text_bytes(b.column(last))
            data = data.tobytes()
            found = [feature_buckets(data[i:j], patterns, buckets) for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:last], pa.array([w for w, _ in found], pa.int64()), pa.array([x.astype(kind).tobytes() for _, x in found], pa.binary())],
                names=schema.names)

    return texts.mapInArrow(work, schema)


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows: a task adds up its own first, so at most ``buckets`` rows of it are shuffled."""
    kind = _kind(buckets)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(_packed(b.column(0), kind)[0], minlength=buckets)
        on = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(n[on])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    got = found.select("buckets").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def _packed(col: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all buckets, features of each row)."""
    off = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_binary(col.type) else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]].tobytes() if buf is not None else b""
    return np.frombuffer(data, kind), np.diff(off) // kind.itemsize


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in doubles, floored."""
    buckets = len(raw)
    s_all, t_all = float(raw.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with ``n_features`` and ``weight`` instead of its buckets (last column)."""
    kind, last = _kind(len(gain)), len(found.columns) - 1
    schema = T.StructType([*found.schema.fields[:-1], T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n = _packed(b.column(last), kind)
            sums = np.concatenate([[0], np.cumsum(gain[at])])
            end = np.cumsum(n)
            weight = (sums[end] - sums[end - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(n), pa.array(weight)], names=schema.names)

    return found.mapInArrow(work, schema)


def resample(docs: DataFrame, target: DataFrame, keep: list[str] | None = None, n: int = 1, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` (default: all) of every row of ``docs`` (doc_id, text) with ``n_features``, ``weight``, ``score``
    and ``rank`` (null if not drawn); ``target`` has the texts to come near to."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in _RESULT]
    row = F.struct(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"))
    found = written(scanned(docs.select(row.alias("row"), F.col("text").cast("string").alias("text")), n, buckets), "resample-docs")
    aim = scanned(target.select(F.col("text").cast("string").alias("text")), n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aim, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(name, "UTF-8"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = weighed(found, gain).withColumn("score", F.col("weight") + noise).withColumn("fit", F.col("words") >= least_words)
    rows = placed(rows.orderBy(F.col("fit").desc(), F.col("score").desc(), F.col("row.id").asc_nulls_last()), "at")
    fit = found.filter(F.col("words") >= least_words).count()
    drawn = F.col("fit") & (F.col("at") < F.lit(percent * fit // 100))
    return rows.select(*[F.col("row.kept").getField(c).alias(c) for c in keep], "n_features", "weight", F.col("score").cast("long").alias("score"),
                       F.when(drawn, F.col("at") + 1).alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, with their results."""
    return resample(docs, target, **options).filter("rank IS NOT NULL")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, its score and its rank among the drawn ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])


OP13_SQL = r"""
WITH RECURSIVE step(i, j, c) AS (
    SELECT i, 0, i FROM range(256) AS r(i)
    UNION ALL SELECT i, j + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE j < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM step WHERE j = 8),
both_of AS (
    SELECT row_number() OVER () AS r, doc_id, false AS aim, text FROM documents UNION ALL SELECT -1, NULL, true, text FROM benchmark),
word AS MATERIALIZED (
    SELECT r, aim, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM both_of),
bucket AS MATERIALIZED (
    SELECT w, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
        lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) % 10000 AS b
    FROM (SELECT DISTINCT w, hex(encode(w)) AS x FROM word), crc),
n AS (SELECT b, count(*) FILTER (NOT aim) AS s, count(*) FILTER (aim) AS t FROM word JOIN bucket USING (w) GROUP BY b),
gain AS (
    SELECT b, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM n),
weight AS (
    SELECT r, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS g FROM word JOIN bucket USING (w) JOIN gain USING (b) WHERE NOT aim GROUP BY r),
score AS (
    SELECT r, doc_id, coalesce(n_features, 0) AS n_features,
        CASE WHEN n_features IS NULL THEN 0 ELSE (g - ((g % n_features) + n_features) % n_features) // n_features END AS weight,
        CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM both_of LEFT JOIN weight USING (r) WHERE NOT aim),
line AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM score),
fit AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM line WHERE n_features >= 20)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
    CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM line LEFT JOIN fit USING (r)
"""
