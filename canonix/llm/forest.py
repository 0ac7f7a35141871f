r"""A MinHash LSH forest over texts: sorted labels, the tries they span, and how far matched prefixes are shortened.

Each of ``trees`` trees gives a text a label of ``depth`` values of 16 bits, each a hash of a minimum over the
text's shingles. All labels are sorted by (tree, label, text), so the texts below a node of a tree's trie, those that
share a prefix, stand together. Sorting is by range and texts break ties: many equal labels are cut over tasks as
any other rows. A task goes through its sorted rows once and needs the row before and, for each depth, the first
text of the present run. It gives each row one edge, to the first text of the run that shares its longest match,
with that match's length as its level. The edges of a level or more connect just the texts that share prefixes
of that length with each other. Runs that go on over the end of a task are joined by an edge between both tasks' rows there.

Prefixes start at full length and are shortened until pairs are found with the target recall: two texts of
similarity s share a prefix of d values in some of t trees with the chance ``1 - (1 - s ** d) ** t``. The data say
which s there is: each edge's texts are compared by all values of their labels, and the least similar pair that
may reach the threshold (within three standard deviations) decides. Below the depth that suffices at the threshold
itself no prefix needs to be shortened.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canonix.llm import words as W
from canonix.llm.places import written

_EDGE, _FIRST, _LAST = 0, 1, 2


def text_labels(gram: np.ndarray, first: np.ndarray, trees: int, depth: int, seed: int = 3) -> np.ndarray:
    """(rows with shingles, trees * depth) of 16-bit values; ``gram`` holds the rows' shingles, ``first`` where each begins."""
    rng = np.random.default_rng(seed)
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(full), trees * depth), np.uint16)
    for j in range(trees * depth if len(full) else 0):
        mul = rng.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, dtype=np.uint64)
        out[:, j] = W.mixed(np.minimum.reduceat((gram * mul + add) >> np.uint64(16), first[full])) >> np.uint64(48)
    return out


def prefix_keys(labels: np.ndarray, trees: int, use: int) -> np.ndarray:
    """(rows, trees): a 64-bit fingerprint of the first ``use`` values of each tree's label."""
    values = labels.reshape(len(labels), trees, -1).astype(np.uint64)
    keys = np.zeros(values.shape[:2], np.uint64)
    for j in range(use):
        keys = W.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, j] + np.uint64(1))
    return keys.view(np.int64)


def from_binary(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, width)


def prefix_depth(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which pairs of a similarity meet in some tree with the recall asked for."""
    d = depth
    while d > 1 and 1 - (1 - similarity ** d) ** trees < recall:
        d -= 1
    return d


def settled_depth(agree: Iterable[int], threshold: float, trees: int, depth: int, recall: float) -> int:
    """How long prefixes may stay, given the numbers of equal values (of ``trees * depth``) that pairs have."""
    values = trees * depth
    doubt = 3 * (threshold * (1 - threshold) / values) ** 0.5
    seen = [n / values for n in agree if n / values + doubt >= threshold]
    if not seen:
        return depth
    return prefix_depth(max(threshold, min(seen) - doubt), trees, depth, recall)


def _neighbours(depth: int, least: int):
    """For ``mapInArrow`` over sorted (tree, label, node): edges of level ``least`` or more, and the first and last row of the task."""
    names = ["kind", "tree", "label", "a", "b", "level"]

    def border(kind: int, tree: int, label: bytes, node: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), pa.array([tree], pa.int32()), pa.array([label], pa.binary()), pa.array([node], pa.binary()),
             pa.array([None], pa.binary()), pa.array([None], pa.int32())], names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, heads = None, [b""] * (depth + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy().astype(np.int64)
            label, node = from_binary(batch.column(1), depth), batch.column(2)
            if before is None:
                yield border(_FIRST, int(tree[0]), label[0].tobytes(), node[0].as_py())
                before = (-1, label[0])
            same = np.cumprod(label == np.concatenate([before[1][None], label[:-1]]), axis=1).sum(axis=1)
            level = np.where(tree == np.append(before[0], tree[:-1]), same, 0)
            known = [pa.array([], pa.int32())], [pa.array([], pa.binary())], [pa.array([], pa.binary())]
            for d in range(least, depth + 1):
                # The first row of the run of ``d`` equal values that each row is in; -1: the one begun in an earlier batch.
                lead = np.maximum.accumulate(np.where(level < d, np.arange(len(level)), -1))
                begin = pa.concat_arrays([pa.array([heads[d]], pa.binary()), node]).take(pa.array(lead + 1))
                heads[d] = begin[len(begin) - 1].as_py()
                mine = pa.array(np.flatnonzero(level == d))
                for held, found in zip(known, (pa.array(np.full(len(mine), d, np.int32)), node.take(mine), begin.take(mine)), strict=True):
                    held.append(found)
            n, a, b = (pa.concat_arrays(c) for c in known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), _EDGE, np.int32)), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary()), a, b, n], names=names)
            before = (int(tree[-1]), label[-1])
            last = node[len(node) - 1].as_py()
        if before is not None:
            yield border(_LAST, before[0], before[1].tobytes(), last)

    return work


def _equal_values(label, other, depth: int):
    """Length of the common prefix of two labels (columns)."""
    return sum(((F.substring(label, 1, 2 * d) == F.substring(other, 1, 2 * d)).cast("int") for d in range(1, depth + 1)), F.lit(0))


def forest_edges(texts: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """(a, b, level) of the tries of ``texts`` (node, labels): matches of ``least`` values or more."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = texts.select("node", "labels", tree.alias("tree"))
    rows = rows.select("tree", F.expr(f"substring(labels, {2 * depth} * tree + 1, {2 * depth})").alias("label"), "node")
    rows = rows.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    found = written(rows.mapInArrow(_neighbours(depth, least), "kind int, tree int, label binary, a binary, b binary, level int"), "forest")
    # Two rows a task: what the first row of one shares with the last of the one before.
    order = Window.partitionBy("tree").orderBy("label", "a", "kind")
    ends = found.filter(F.col("kind") != _EDGE).withColumns({"b": F.lag("a").over(order), "other": F.lag("label").over(order)})
    ends = ends.filter((F.col("kind") == _FIRST) & F.col("b").isNotNull()).withColumn("level", _equal_values(F.col("label"), F.col("other"), depth))
    ends = ends.filter(F.col("level") >= least)
    return found.filter(F.col("kind") == _EDGE).select("a", "b", "level").unionByName(ends.select("a", "b", "level"))


def shortened(edges: DataFrame, texts: DataFrame, threshold: float, trees: int, depth: int, recall: float) -> int:
    """The length to which matched prefixes are shortened, from the similarity of all pairs that ``edges`` name."""
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("labels").alias("x")), "a")
    pairs = pairs.join(texts.select(F.col("node").alias("b"), F.col("labels").alias("y")), "b")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            equal = from_binary(b.column(0), trees * depth) == from_binary(b.column(1), trees * depth)
            agree, n = np.unique(equal.sum(axis=1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(agree), pa.array(n)], names=["agree", "n"])

    # One number of equal values a row: trees * depth + 1 rows at most.
    counts = pairs.select("x", "y").mapInArrow(work, "agree long, n long").groupBy("agree").agg(F.sum("n")).collect()
    return settled_depth([r["agree"] for r in counts], threshold, trees, depth, recall)
