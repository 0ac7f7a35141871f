r"""Benchmark decontamination with suffix arrays of the training text.

Every shard of a task's documents (a slice of about 4 MB, of a longer text 2^20 words and the 12 after them) gets the
complete suffix array of its words (suffixes.py). Every test suffix that begins a window is looked up by binary search
and gives all places of its window; each match is then followed word by word to its end, so matches
are whole. Arrays live as long as their slice is worked on; each block of items (below) builds them anew.

A window is 13 consecutive words of an item (an item of fewer words, but not none, is one window). A
document word inside an occurrence of a window is hit; a document with ``n_hit > 0`` and
``20 * n_hit >= n_words`` is contaminated. Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are
lowered, compared by 64-bit fingerprints.

The items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text; more items mean more passes,
whose hits add up. Defined results: null text has no words; items without words match nothing; null
``item_id`` takes part but is not listed; repeated documents each get their own row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.llm import suffixes
from canonix.llm import words as W
from canonix.session import scratch_path

WINDOW = 13
BLOCK_BYTES = 32 << 20


def item_windows(ids: list, col: pa.Array, window: int = WINDOW) -> dict:
    """The items' words (one fingerprint each), and their windows by length: item number and place of each."""
    data, off = W.text_bytes(col)
    data = W.lowered(data)
    ws, we, first = W.word_spans(data, off, W.alphanumeric())
    h = W.word_hashes(data, ws, we)
    size = np.diff(first)
    out = []
    for n in sorted(set(np.minimum(size, window).tolist()) - {0}):
        at = W.inside_rows(first, n)
        of = W.row_of(first, at)
        at = at[np.minimum(size, window)[of] == n]
        out.append({"n": n, "item": W.row_of(first, at).astype(np.int32), "at": at})
    return {"ids": ids, "hashes": h, "first": first, "windows": out}


def longest(h: np.ndarray, first: np.ndarray, items: dict, at: np.ndarray, size: np.ndarray, test: np.ndarray) -> np.ndarray:
    """How many words each match goes on, from position ``at`` here and ``test`` in the items."""
    stop = first[W.row_of(first, at) + 1]
    test_stop = items["first"][W.row_of(items["first"], test) + 1]
    size = size.copy()
    live = np.arange(len(at))
    while len(live):
        live = live[(at[live] + size[live] < stop[live]) & (test[live] + size[live] < test_stop[live])]
        live = live[h[at[live] + size[live]] == items["hashes"][test[live] + size[live]]]
        size[live] += 1
    return size


def _blocks(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    benchmark = benchmark.distinct()  # repeated rows would all be in one block
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // limit) or 1
    if n == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n))  # twice as many, as they differ in size
    return [benchmark.filter(part == i) for i in range(2 * n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, ``__hits`` (start and length in words of matched stretches, each from a window on
    as far as it goes), ``__items`` and ``__matches`` (item, word in item, word in document, length) of the longest match
    of each item."""
    spark = docs.sparkSession
    stretch = T.StructType([T.StructField("at", T.LongType()), T.StructField("size", T.LongType())])
    match = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("item_at", T.LongType()),
                          T.StructField("at", T.LongType()), T.StructField("size", T.LongType())])
    new = [T.StructField("__n_words", T.LongType()), T.StructField("__hits", T.ArrayType(stretch)),
           T.StructField("__matches", T.ArrayType(match))]
    plain = list(docs.columns)
    blocks = _blocks(benchmark.select(F.col("item_id").cast("long"), "text"), block_bytes)
    for k, block in enumerate(blocks):
        rows = block.orderBy("item_id", "text").toArrow()
        shared = spark.sparkContext.broadcast(item_windows(
            rows["item_id"].to_pylist(), rows["text"].combine_chunks().cast(pa.string()), window))
        text = docs.columns.index("text")
        later = k > 0

        def work(batches: Iterable[pa.RecordBatch], shared=shared, text=text, later=later) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for b in W.text_slices(batches, text):
                n_words, hits, matches = _hits(b.column(text), items)
                kept = [b.column(i) for i in range(len(plain))]
                if later:
                    hits = [a + c for a, c in zip(b.column(len(plain) + 1).to_pylist(), hits, strict=True)]
                    matches = [a + c for a, c in zip(b.column(len(plain) + 2).to_pylist(), matches, strict=True)]
                made = [pa.array(n_words, pa.int64()), pa.array(hits, hit_type), pa.array(matches, match_type)]
                yield pa.RecordBatch.from_arrays(kept + made, names=[*plain, "__n_words", "__hits", "__matches"])

        hit_type = pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())]))
        match_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in match]))
        schema = T.StructType(docs.schema.fields[:len(plain)] + new)
        docs = docs.mapInArrow(work, schema)
        if k + 1 < len(blocks):  # the next pass reads these from files, so that this broadcast may go
            out = scratch_path(spark, "decontaminate")
            docs.write.parquet(out)
            docs = spark.read.parquet(out)
    return docs


def _hits(col: pa.Array, items: dict) -> tuple[np.ndarray, list, list]:
    data, off = W.text_bytes(col)
    data = W.lowered(data)
    ws, we, first = W.word_spans(data, off, W.alphanumeric())
    h = W.word_hashes(data, ws, we)
    n = len(col)
    hits, matches = [[] for _ in range(n)], [[] for _ in range(n)]
    parts = list(suffixes.shards(h, first, max(w["n"] for w in items["windows"]) - 1)) if items["windows"] else []
    for windows in items["windows"]:
        found = [suffixes.occurrences(p, items["hashes"], windows["at"], windows["n"]) for p in parts]
        if not sum(len(at) for at, _ in found):
            continue
        at, which = (np.concatenate(x) for x in zip(*found))
        item, test = windows["item"][which], windows["at"][which]
        size = longest(h, first, items, at, np.full(len(at), windows["n"]), test)
        row = W.row_of(first, at)
        order = np.lexsort([at, -size, item, row])
        at, size, item, test, row = (x[order] for x in (at, size, item, test, row))
        # Of the matches that begin at a word the longest is enough; of those of an item the first of the longest.
        begin = np.lexsort([-size, at])
        _, lead = np.unique(at[begin], return_index=True)
        for i in begin[lead].tolist():
            r = int(row[i])
            mine, start, length = hits[r], int(at[i] - first[r]), int(size[i])
            if mine and mine[-1]["at"] <= start <= mine[-1]["at"] + mine[-1]["size"]:
                mine[-1]["size"] = max(mine[-1]["size"], start + length - mine[-1]["at"])
            else:
                mine.append({"at": start, "size": length})
        _, lead = np.unique(row * len(items["ids"]) + item, return_index=True)
        for i in lead.tolist():
            r, it = int(row[i]), int(item[i])
            matches[r].append({"item_id": items["ids"][it], "item_at": int(test[i] - items["first"][it]),
                               "at": int(at[i] - first[r]), "size": int(size[i])})
    return np.diff(first), hits, matches


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """The documents that are not contaminated, all columns as they are."""
    found = find_hits(docs, benchmark, **options)
    hit = _covered(F.col("__hits"))
    return found.filter(~((hit > 0) & (hit * share >= F.col("__n_words")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _covered(hits):
    """Words that any of the stretches covers: in order of their start, each adds what lies past the end so far."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(hits), start, lambda s, x: F.struct(
        F.greatest(s["end"], x["at"] + x["size"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0).cast("long"), x["at"] + x["size"] - F.greatest(s["end"], x["at"]))).alias("n")),
        lambda s: s["n"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without the benchmark's passages."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its hit words, the items found in it and the verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.array_distinct(F.transform(
        F.filter("__matches", lambda m: m["item_id"].isNotNull()), lambda m: m["item_id"].cast("string"))))
    hit = _covered(F.col("__hits"))
    out = found.select("doc_id", F.col("__n_words").alias("n_words"), hit.alias("n_hit"),
                       F.size(ids).cast("long").alias("n_items"),
                       F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


OP10_SQL = r"""
WITH item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
place AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)),
hit AS (SELECT place.r, item_id, place.n, i FROM place JOIN win USING (n, s)),
word AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""
