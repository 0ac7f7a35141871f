"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix, which spreads their lengths evenly over the
dimensions, and assigned to the nearest of some centroids. A query scans the lists of its nearest
centroids in blocks of columns: after each block the distance so far, scaled to all dimensions, is
tested against the tenth best distance; candidates that are beyond it by more than chance explains are
abandoned. Those left are measured on the original vectors in double precision.

Centroids are fitted to ``SAMPLE`` vectors at most, chosen by a hash of the id; every vector is indexed. How many lists a
query scans is measured: for ``MEASURED`` different query vectors at most the true neighbours among all rows are found,
and as many lists are scanned as it takes to hold ``RECALL`` of them. Vectors in clusters need few lists, those without
structure most of them (no index does better there). Up to ``LISTS`` lists their number follows the square root of
the rows, so a query's work does, too, where the share of lists falls accordingly.

Lists are cut into blocks of ``BLOCK`` vectors and queries into groups of ``BLOCK``, so a hot list or
many equal vectors are shared by tasks; each task keeps ten rows for a query. Defined results: vectors
that are null, of length zero or hold null or non-finite components, and rows without id, take no part;
vectors are compared with those of the same dimension; every row but the query's own is its candidate, other rows of
the same id too, and each row of a repeated query id is a query; if fewer than ten candidates exist all are
returned; ties go to the smaller id. Distances whose squares are beyond a double are measured in units of their largest part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canonix.session import scratch_path

SAMPLE = 20_000
BLOCK = 4096
#: Most lists, and the least number of them that a query scans.
LISTS, LEAST_PROBES = 4096, 16
#: Query vectors whose true neighbours tell how many lists to scan, and the share of these that the lists have to hold.
MEASURED, RECALL = 128, 0.97
#: Columns at a time, and how many standard deviations a distance must be beyond the bound.
COLUMNS, SURE = 16, 2.5


def usable(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col(f"`{column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True))
                       & F.exists("v", lambda x: x != 0))


def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from random rows; a centroid that loses all rows stays where it is."""
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, c)[:, 0]
        n = np.bincount(own, minlength=len(c))
        for j in np.flatnonzero(n):
            c[j] = x[own == j].mean(axis=0)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, n: int = 1) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    own = (c * c).sum(axis=1)
    out = np.empty((len(x), n), np.int64)
    step = max(1, (4 << 20) // len(c))  # at most 32 MB of distances at a time
    for lo in range(0, len(x), step):
        far = own - 2 * (x[lo:lo + step] @ c.T)
        out[lo:lo + step] = far.argmin(axis=1)[:, None] if n == 1 else np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(-1, d)


def _blobs(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def _from_blobs(col: pa.ChunkedArray, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(-1, d)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` from ``q``, also where squares are too large or too small for a double."""
    part = x - q
    with np.errstate(over="ignore"):
        far = np.sqrt((part * part).sum(axis=1))
    off = np.flatnonzero(~np.isfinite(far) | (far < 1e-140))
    if len(off):
        part = np.abs(part[off])
        unit = part.max(axis=1)
        some = (unit > 0) & np.isfinite(unit)
        part[some] /= unit[some, None]
        far[off] = np.where(some, unit * np.sqrt((part * part).sum(axis=1)), unit)
    return far


def scan(ids: np.ndarray, other: np.ndarray, rotated: np.ndarray, exact: np.ndarray, rq: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, distances) of the nearest ``k`` found among the rows ``other`` of one block, nearest first."""
    d = rotated.shape[1]

    def best(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = distances(exact[rows], q)
        order = np.lexsort([ids[rows], far])[:k]
        return rows[order], far[order]

    first, rest = other[:4 * k], other[4 * k:]
    near, far = best(first)
    if len(near) == k and len(rest):
        bound = far[-1] * far[-1]
        sums, done = np.zeros(len(rest)), 0
        while done < d and len(rest):
            part = rotated[rest, done:done + COLUMNS] - rq[done:done + COLUMNS]
            sums += (part * part).sum(axis=1)
            done = min(d, done + COLUMNS)
            limit = bound * (1 + 1e-9) if done == d else bound * done / d * (1 + SURE / np.sqrt(done)) ** 2
            stay = sums <= limit
            rest, sums = rest[stay], sums[stay]
    return best(np.concatenate([near, rest])) if len(rest) else (near, far)


def _true_neighbours(indexed: DataFrame, q: np.ndarray, own: np.ndarray, k: int) -> pa.Table:
    """(query, list) of the ``k`` nearest among all rows but the own for each of a bounded number of vectors ``q``."""
    d, middle = q.shape[1], q.mean(axis=0)
    told = indexed.sparkSession.sparkContext.broadcast((q - middle, own, middle))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own, middle = told.value
        # For each query the nearest rows of the task so far: distance, id, list.
        held = [np.full((len(q), 0), 0.0), np.full((len(q), 0), 0), np.full((len(q), 0), 0)]
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                b = whole.slice(lo, BLOCK)
                x = _from_blobs(b.column(2), d) - middle
                with np.errstate(all="ignore"):
                    far = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * (q @ x.T)
                far = np.where(np.isnan(far) | (own[:, None] == b.column(3).to_numpy()), np.inf, np.maximum(far, 0))
                new = [far] + [np.broadcast_to(b.column(i).to_numpy(), far.shape) for i in (1, 0)]
                held = [np.concatenate(x, axis=1) for x in zip(held, new, strict=True)]
                best = np.lexsort([held[1], held[0]], axis=1)[:, :k]
                held = [np.take_along_axis(x, best, axis=1) for x in held]
        far, ids, lists = held
        i, j = np.nonzero(np.isfinite(far))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(lists[i, j]), pa.array(ids[i, j]), pa.array(far[i, j])],
                                         names=["query", "list", "vec_id", "score"])

    found = indexed.select("list", "vec_id", "x", "row").mapInArrow(work, "query long, list long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "list").toArrow()
    told.destroy()
    return out


def needed_probes(indexed: DataFrame, queries: DataFrame, turn: np.ndarray, c: np.ndarray, k: int, recall: float = RECALL) -> int:
    """How many of the nearest lists hold ``recall`` of the true neighbours, as a mean over different query vectors."""
    if len(c) <= LEAST_PROBES:
        return len(c)
    some = queries.groupBy("x").agg(F.min("row").alias("row")).orderBy(F.xxhash64("x"), "x").limit(MEASURED).toArrow()
    if not some.num_rows:
        return LEAST_PROBES
    q = _from_blobs(some["x"], len(turn))
    true = _true_neighbours(indexed, q, some["row"].to_numpy(), k)
    query, lists = true["query"].to_numpy(), true["list"].to_numpy()
    if not len(query):
        return len(c)
    place = np.argsort(_nearest(q @ turn, c, len(c)), axis=1)[query, lists]
    of = np.bincount(query, minlength=len(q))
    held = np.cumsum(np.bincount(place, 1 / of[query], len(c))) / np.count_nonzero(of)
    return min(len(c), max(LEAST_PROBES, int(np.searchsorted(held, recall - 1e-9)) + 1))


def _search_dimension(rows: DataFrame, d: int, divisor: int, k: int, lists: int | None) -> DataFrame:
    spark = rows.sparkSession
    turn = rotation(d)
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    n_lists = lists or max(1, min(LISTS, round(np.sqrt(total) / 2)))
    c = centroids(_matrix(sample["v"].combine_chunks(), d) @ turn, n_lists)
    shared = spark.sparkContext.broadcast((turn, c))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, c = shared.value
        for b in batches:
            x = _matrix(b.column(1), d)
            r = x @ turn
            yield pa.RecordBatch.from_arrays([pa.array(_nearest(r, c)[:, 0]), b.column(0), _blobs(x), b.column(2)], names=["list", "vec_id", "x", "row"])

    out = scratch_path(spark, "vector-index")
    rows.mapInArrow(index, "list long, vec_id long, x binary, row long").write.parquet(out)
    indexed = spark.read.parquet(out)
    queries = indexed.filter(F.col("vec_id") % divisor == 0).select("vec_id", "x", "row")
    # At most LISTS rows, whatever the number of vectors.
    size = np.zeros(len(c), np.int64)
    for r in indexed.groupBy("list").count().collect():
        size[r["list"]] = r["count"]
    probes = needed_probes(indexed, queries, turn, c, k)

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, c = shared.value
        for b in batches:
            q = _from_blobs(b.column(1), d)
            near = _nearest(q @ turn, c, len(c)) if len(c) > 1 else np.zeros((len(q), 1), np.int64)
            # The nearest lists, and more until they hold enough rows besides the query's own.
            held = np.cumsum(size[near], axis=1) - size[near]
            use = (np.arange(near.shape[1]) < probes) | (held < k + 1)
            use &= size[near] > 0
            i, j = np.nonzero(use)
            yield pa.RecordBatch.from_arrays([pa.array(near[i, j]), *(b.column(n).take(pa.array(i)) for n in range(3))],
                                             names=["list", "query_id", "q", "query_row"])

    probed = queries.mapInArrow(probe, "list long, query_id long, q binary, query_row long")
    out = scratch_path(spark, "vector-probes")
    probed.write.parquet(out)
    probed = spark.read.parquet(out)
    asked = np.zeros(len(c), np.int64)
    for r in probed.groupBy("list").count().collect():
        asked[r["list"]] = r["count"]
    # Blocks of a list and groups of its queries: each pair of both meets in one task.
    cut = spark.createDataFrame([(i, max(1, -(-int(s) // BLOCK)), max(1, -(-int(a) // BLOCK)))
                                 for i, (s, a) in enumerate(zip(size, asked, strict=True))], "list long, blocks long, groups int")
    left = indexed.join(F.broadcast(cut), "list").select(
        "list", F.pmod(F.xxhash64("row"), "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"), "vec_id", "x", "row")
    right = probed.join(F.broadcast(cut), "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_row"), "groups").cast("int").alias("grp"), "query_id", "q", "query_row")

    def meet(vectors: pa.Table, asking: pa.Table) -> pa.Table:
        turn, _ = shared.value
        found: list[list] = [[], [], [], []]
        if vectors.num_rows and asking.num_rows:
            ids, row = vectors["vec_id"].to_numpy(), vectors["row"].to_numpy()
            x, q = _from_blobs(vectors["x"], d), _from_blobs(asking["q"], d)
            r, rq = x @ turn, q @ turn
            for i, (query, own) in enumerate(zip(asking["query_id"].to_pylist(), asking["query_row"].to_pylist(), strict=True)):
                near, far = scan(ids, np.flatnonzero(row != own), r, x, rq[i], q[i], k)
                found[0] += [query] * len(near)
                found[1] += ids[near].tolist()
                found[2] += far.tolist()
                found[3] += [own] * len(near)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names=["query_id", "vec_id", "score", "query_row"])

    keys = ["list", "block", "grp"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double, query_row long")


def nearest_vectors(vectors: DataFrame, divisor: int = 100, k: int = 10, lists: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id ``divisor`` divides its ``k`` nearest found."""
    spark = vectors.sparkSession
    out = scratch_path(spark, "vectors")
    usable(vectors).withColumns({"d": F.size("v"), "row": F.monotonically_increasing_id()}).write.parquet(out)
    rows = spark.read.parquet(out)
    dims = sorted(r["d"] for r in rows.select("d").distinct().collect())
    parts = [_search_dimension(rows.filter(F.col("d") == d).select("vec_id", "v", "row"), d, divisor, k, lists) for d in dims]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for each query row of ``embeddings``."""
    return nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
