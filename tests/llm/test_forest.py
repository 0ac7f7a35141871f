"""The LSH forest against tries built by hand, and the recall of shortened prefixes."""

import numpy as np
import pytest

from canonix.llm import forest, neardup
from canonix.llm.components import components

TREES, DEPTH = 3, 4


def _labels(seed, n, values):
    return np.random.default_rng(seed).integers(0, values, (n, TREES * DEPTH)).astype(np.uint16)


def _classes(n, pairs):
    name = list(range(n))
    for i, j in pairs:
        a, b = name[i], name[j]
        name = [min(a, b) if x in (a, b) else x for x in name]
    return name


@pytest.mark.parametrize("values,batch", [(2, 10_000), (2, 3), (6, 1), (1, 7)])
def test_edges_join_what_shares_prefixes(spark, values, batch):
    n = 60
    labels = _labels(values, n, values)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many tasks as there may be
    try:
        texts = spark.createDataFrame([(b"%03d" % i, x.tobytes()) for i, x in enumerate(labels)], "node binary, labels binary")
        edges = forest.forest_edges(texts, TREES, DEPTH, 1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(edges) <= TREES * (n - 1)
    parts = labels.reshape(n, TREES, DEPTH)
    for use in range(1, DEPTH + 1):
        want = [(i, j) for i in range(n) for j in range(i) if (parts[i, :, :use] == parts[j, :, :use]).all(axis=1).any()]
        got = [(int(bytes(e["a"])), int(bytes(e["b"]))) for e in edges if e["level"] >= use]
        assert _classes(n, got) == _classes(n, want)
        keys = forest.prefix_keys(labels, TREES, use)
        assert {(i, j) for i in range(n) for j in range(i) if (keys[i] == keys[j]).any()} == set(want)


def test_depth_follows_the_least_similar_pairs():
    trees, depth, recall = neardup.TREES, neardup.DEPTH, neardup.RECALL
    whole = trees * depth
    assert forest.settled_depth([], 0.8, trees, depth, recall) == depth
    assert forest.settled_depth([whole, 3, 20], 0.8, trees, depth, recall) == depth  # 20 of 128 cannot be similar
    depths = [forest.settled_depth([whole, n], 0.8, trees, depth, recall) for n in range(whole, 88, -1)]
    assert depths == sorted(depths, reverse=True) and depths[-1] == 5 == forest.prefix_depth(0.8, trees, depth, recall)
    for s in (0.8, 0.85, 0.9):
        d = forest.prefix_depth(s, trees, depth, recall)
        assert 1 - (1 - s ** d) ** trees >= recall


def test_links_found_at_the_threshold(spark, tmp_path):
    """Pairs of similarity 0.8 to 0.83: at least 0.98 of them are linked."""
    rnd = np.random.default_rng(9)
    rows = []
    for p in range(150):
        words = [f"p{p}w{i}" for i in range(100)]
        other = list(words)
        for i in rnd.choice([10, 50, 90], 2, replace=False):  # five shingles each: 86 of 106
            other[i] = "x"
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(other))]
    path = str(tmp_path) + "/d"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    docs, _ = neardup.numbered(spark.read.parquet(path), "__row")
    got = {r["doc_id"]: r for r in neardup.near_classes(docs).collect()}
    found = sum(got[2 * p]["class"] == got[2 * p + 1]["class"] for p in range(150))
    assert len(got) == 300 and found >= 147
    assert all(r["n_links"] == (got[i ^ 1]["class"] == r["class"]) for i, r in got.items())


def test_pairs_far_above_the_threshold_stop_early(spark):
    labels = np.random.default_rng(2).integers(0, 60_000, (40, 128)).astype(np.uint16)
    labels[20:] = labels[:20]
    labels[20:, ::64] += 1  # 126 of 128 values agree
    texts = spark.createDataFrame([(b"%02d" % i, x.tobytes()) for i, x in enumerate(labels)], "node binary, labels binary")
    edges = forest.forest_edges(texts, 16, 8, 5)
    assert forest.shortened(edges, texts, 0.8, 16, 8, 0.995) == 8
    assert components(edges.filter("level >= 8")).select("root").distinct().count() == 20
