"""Distributed union-find: connected components by alternating star contractions (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonix.session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` by way of the shared folder: lineage ends here and lost executors cost nothing."""
    out = scratch_path(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; ``root`` is the least node of its component.

    Each round hangs a node's larger neighbours, then its smaller ones, on the least of them. It ends when
    a round changes nothing. Joins carry the hubs, so a large star is split by adaptive skew handling.
    """
    x, y = F.col(a), F.col(b)
    pairs = edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    pairs = _written(pairs, "components")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "w").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(least, "u").filter("v != w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        pairs = _written(small.unionByName(least.select("u", F.col("w").alias("v"))).distinct(), "components")
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
