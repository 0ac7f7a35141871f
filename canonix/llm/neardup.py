r"""N-gram Jaccard join by a MinHash LSH forest.

Texts are sets of 5-word shingles (words ``[^\x20\x09-\x0D]+``; a text of fewer words, but not none, is
one shingle). Each of ``TREES`` trees of the forest (forest.py) has the texts' labels of ``DEPTH`` MinHash values in sorted
order, so a trie's nodes are stretches of it. Matched prefixes are shortened, from whole labels on, until texts that may be
similar share one in some tree with the target recall; how similar the least similar such texts are is taken from the
data. Texts that share a prefix of that length are candidates; all candidates are verified by the exact Jaccard
similarity of their shingle sets (64-bit fingerprints of the shingles), and similar texts form classes.

Equal texts are one text from the start. Candidates are gathered by connected groups of the forest's edges, every
text once; a group of more than ``BLOCK`` texts is cut into blocks, and each pair of blocks is a task's
work. Pairs are counted where they are verified and never leave as rows: each text sends its number of
links and one edge to the least text it hangs together with.

Defined results: null text is empty; texts without words are similar only to equal texts; null ids
stay, a class is named by its least id; rows that repeat an id count as documents of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.llm import words as W
from canonix.llm.components import _written, components
from canonix.llm.forest import forest_edges, from_binary, prefix_depth, prefix_keys, shortened, text_labels
from canonix.llm.shard import numbered

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH, RECALL = 16, 8, 0.995
BLOCK = 256


def shingle_sets(col: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints sorted within rows and without repeats, first of each row plus the total)."""
    data, off = W.text_bytes(col)
    ws, we, first = W.word_spans(data, off, W.space_separated())
    h = W.word_hashes(data, ws, we)
    at = W.inside_rows(first, n)
    rows, grams = [W.row_of(first, at)], [W.gram_hashes(h, n)[at]]
    size = np.diff(first)
    for k in range(1, n):  # whole short texts
        short = np.flatnonzero(size == k)
        if len(short):
            rows.append(short)
            grams.append(W.gram_hashes(h, k)[first[short]])
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort([gram, row])
    row, gram = row[order], gram[order]
    if len(row):
        new = np.append(True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]))
        row, gram = row[new], gram[new]
    return gram, np.searchsorted(row, np.arange(len(col) + 1))


def _digests(col: pa.Array) -> list[bytes]:
    return [hashlib.blake2b(x or b"", digest_size=16).digest() for x in col.cast(pa.binary()).to_pylist()]


def signatures(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """(row, doc_id, digest, labels): ``labels`` holds the values of all trees, null for texts without words."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.text_slices(batches, 2, 1 << 20):
            gram, first = shingle_sets(b.column(2))
            labels = iter(text_labels(gram, first, trees, depth))
            found = [next(labels).tobytes() if n else None for n in np.diff(first).tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_digests(b.column(2)), pa.binary()), pa.array(found, pa.binary())],
                                             names=["row", "doc_id", "digest", "labels"])

    return docs.select("__row", F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "row long, doc_id long, digest binary, labels binary")


def _candidate_texts(docs: DataFrame, groups: DataFrame, trees: int, depth: int, use: int) -> DataFrame:
    """(node, root, keys, grams): the prefixes and the shingle set of each candidate text, once. ``groups`` names one row for each text."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.text_slices(batches, 3, 1 << 20):
            gram, first = shingle_sets(b.column(3))
            grams = [gram[first[i]:first[i + 1]].tobytes() for i in range(b.num_rows)]
            keys = prefix_keys(from_binary(b.column(2), trees * depth), trees, use)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, trees, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists, pa.array(grams, pa.binary())],
                                             names=["node", "root", "keys", "grams"])

    rows = docs.select(F.col("__row").alias("row"), "text").join(groups, "row")
    return rows.select("node", "root", "labels", "text").mapInArrow(work, "node binary, root binary, keys array<long>, grams binary")


class _Block:
    """Candidate texts that one task compares: all of a block, or those of one block with those of another."""

    def __init__(self, same: bool, threshold: float):
        self.same, self.threshold, self.nodes, self.sides, self.keys, self.grams = same, threshold, [], [], [], []

    def add(self, node: bytes, side: int, keys: np.ndarray, grams: bytes) -> None:
        self.nodes.append(node)
        self.sides.append(side)
        self.keys.append(keys)
        self.grams.append(np.frombuffer(grams, np.uint64))

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common shingles of the pairs ``a[i], b[i]``."""
        if len(a) <= 2 * len(self.nodes):
            return np.array([len(np.intersect1d(self.grams[i], self.grams[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
        # Many pairs: multiply the tables of who has which shingle, some columns at a time.
        text = np.repeat(np.arange(len(self.grams)), [len(g) for g in self.grams])
        _, column, count = np.unique(np.concatenate(self.grams), return_inverse=True, return_counts=True)
        often = count > 1
        column, text = (np.cumsum(often) - 1)[column[often[column]]], text[often[column]]
        total = np.zeros((len(self.grams), len(self.grams)), np.float32)
        order = np.argsort(column, kind="stable")
        column, text = column[order], text[order]
        for lo in range(0, int(often.sum()), 4096):
            i, j = np.searchsorted(column, [lo, lo + 4096])
            table = np.zeros((len(self.grams), 4096), np.float32)
            table[text[i:j], column[i:j] - lo] = 1
            total += table @ table.T
        return total[a, b].astype(np.int64)

    def links(self) -> Iterator[tuple[bytes, int, bytes]]:
        """(text, number of similar texts, least text it hangs together with) of those that have any."""
        n = len(self.nodes)
        if n < 2:
            return
        keys, side = np.array(self.keys), np.array(self.sides)
        meet = np.zeros((n, n), bool)
        for t in range(keys.shape[1]):
            meet |= keys[:, t, None] == keys[None, :, t]
        if not self.same:
            meet &= side[:, None] != side[None, :]
        a, b = np.nonzero(np.triu(meet, 1))
        if not len(a):
            return
        size = np.array([len(g) for g in self.grams])
        # Sets of too different sizes cannot be similar.
        near = np.minimum(size[a], size[b]) >= self.threshold * np.maximum(size[a], size[b]) - 1e-9
        a, b = a[near], b[near]
        if not len(a):
            return
        both = self._shared(a, b)
        on = both >= self.threshold * (size[a] + size[b] - both) - 1e-9
        a, b = a[on], b[on]
        count = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        least = np.array(sorted(range(n), key=self.nodes.__getitem__))
        label = np.empty(n, np.int64)
        label[least] = np.arange(n)
        while True:
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            if (low == label).all():
                break
            label = low
        for i in np.flatnonzero(count).tolist():
            yield self.nodes[i], int(count[i]), self.nodes[least[label[i]]]


def _verified(texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, links, root) from every pair of blocks."""
    size = texts.groupBy("root").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    rows = texts.join(size, "root").withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("root", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "keys", "grams")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            now, held = None, _Block(True, threshold)
            for b in batches:
                for root, i, j, side, node, keys, grams in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if (root, i, j) != now:
                        yield from held.links()
                        now, held = (root, i, j), _Block(i == j, threshold)
                    held.add(node, side, np.array(keys, np.int64), grams)
            yield from held.links()

        kept: list[tuple] = []
        for r in found():
            kept.append(r)
            if len(kept) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept)], names=["node", "links", "root"])
                kept = []
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept)], names=["node", "links", "root"])

    # A side of blocks i and j is part of the pair (i, j) once, and a block meets itself once.
    return rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(
        work, "node binary, links long, root binary")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                 recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, class_id, n_links, n_copies, digest, class) of every row of numbered ``docs`` (``__row``).

    ``n_links`` counts different texts that are similar, ``n_copies`` documents with the same text.
    """
    signed = _written(signatures(docs, trees, depth), "signatures")
    texts = signed.groupBy("digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_copies"))
    # Labels of one row of each text.
    once = signed.join(texts.select("row"), "row", "left_semi").select("row", F.col("digest").alias("node"), "labels")
    once = _written(once.filter("labels IS NOT NULL"), "texts")
    edges = forest_edges(once, trees, depth, prefix_depth(threshold, trees, depth, recall))
    use = shortened(edges, once, threshold, trees, depth, recall)
    groups = components(edges.filter(F.col("level") >= use)).join(once, "node").select("node", "root", "row", "labels")
    found = _written(_verified(_written(_candidate_texts(docs, groups, trees, depth, use), "candidates"), threshold, block), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = texts.join(links, texts["digest"] == links["node"], "left").drop("node")
    named = named.join(classes.withColumnRenamed("root", "class"), named["digest"] == F.col("node"), "left").drop("node")
    named = named.withColumn("class", F.coalesce("class", "digest"))
    name = named.groupBy("class").agg(F.min("least_id").alias("class_id"))
    named = named.join(name, "class").select("digest", "class", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    return signed.select("row", "doc_id", "digest").join(named, "digest")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each class: the one with the least id (null ids last, then the first row). Columns as they are."""
    rows, _ = numbered(docs, "__row")
    found = near_classes(rows, **options)
    last = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("row").alias("r"))
    keep = found.groupBy("class").agg(F.min(last).alias("k")).select(F.col("k.r").alias("__kept"))
    return rows.join(keep, rows["__row"] == keep["__kept"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: near copies go, one of each class stays."""
    return keep_one(docs)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class, its number of similar texts and of equal documents."""
    docs, _ = numbered(spark.read.parquet(f"{sf_dir}/documents.parquet"), "__row")
    return near_classes(docs).select("doc_id", "class_id", "n_links", "n_copies")
