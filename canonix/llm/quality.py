"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the raw corpus (every document) and one
of the target (labelled rows of good quality that are not toxic). Each n-gram has the log ratio of
its probabilities under both; a document has the mean ratio of its n-grams (text like the target as a
whole) and the ratios summed over its weakest windows of 4 and 16 words (a short passage unlike the
target). A logistic fit turns them, with the log of the length, into the log odds that a document
belongs to the target; it sees only labelled rows that the models have not counted as target, as
those would look better than other documents. These are the importance weights: k documents, k being the sum of the probabilities over the
corpus, are drawn without replacement by Gumbel top-k, the noise following from id, length of the text in bytes and seed (rows
alike in all of these have one noise).

Bounded parts, all parameters: ``LABELLED`` labelled rows (chosen by a hash of the id) tell the target
and fit the weights; the models have ``2 ** BITS`` places each. Counts, scores, k and the threshold are
of all rows. Defined results: null or empty text, or text without words, has ratio 0; labels that
disagree on an id count as the worse one; rows tied at the threshold stay; with no target or only
target rows among the labels nothing can be told and all rows stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.llm import words as W
from canonix.session import scratch_path

BITS = 20
LABELLED = 200_000
WINDOWS = (4, 16)
#: One in so many labelled rows is for the fit, the others are for the models.
FIT_SHARE = 4
#: Added to target and expected counts, so that rare n-grams say little.
SMOOTH = 2.0
#: Weights are taken to the power of its inverse before sampling: below 1 favours likely documents.
TEMPERATURE = 0.25


def _grams(col: pa.Array, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each model (place, row, first place of each row): words and word pairs as written; lowered words."""
    data, off = W.text_bytes(col)
    ws, we, first = W.word_spans(data, off, W.space_separated())
    h = W.word_hashes(data, ws, we)
    pairs = W.inside_rows(first, 2)
    shift = np.uint64(64 - bits)
    at = np.concatenate([W.row_of(first, np.arange(len(h))), W.row_of(first, pairs)])
    written = np.concatenate([h >> shift, W.gram_hashes(h, 2)[pairs] >> shift]).astype(np.int64)
    data = W.lowered(data)
    ws, we, first = W.word_spans(data, off, W.alphanumeric())
    low = (W.word_hashes(data, ws, we) >> shift).astype(np.int64)
    return [(written, at, first), (low, W.row_of(first, np.arange(len(low))), first)]


def labelled_rows(labels: DataFrame, bound: int = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """(sorted ids, whether target) of at most ``bound`` labelled ids."""
    each = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("target"))
    rows = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()
    found = sorted((r["doc_id"], r["target"]) for r in rows)
    return np.array([i for i, _ in found], np.int64), np.array([t for _, t in found], bool)


def _target_of(ids: np.ndarray, known: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labelled, target) of each id."""
    if not len(known):
        return np.zeros(len(ids), bool), np.zeros(len(ids), bool)
    i = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    on = known[i] == ids
    return on, on & target[i]


def _ids(col: pa.Array) -> np.ndarray:
    return col.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def gram_counts(docs: DataFrame, known: np.ndarray, target: np.ndarray, bits: int = BITS) -> pa.Table:
    """(place, raw, target): n-grams of all documents by place of the two models, summed. Their size is fixed by ``bits``."""
    shared = docs.sparkSession.sparkContext.broadcast((known, target))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 << bits
        raw, good, some = np.zeros(size, np.int64), np.zeros(size, np.int64), False
        for b in W.text_slices(batches, 1):
            some = True
            _, is_target = _target_of(_ids(b.column(0)), *shared.value)
            for model, (place, row, _) in enumerate(_grams(b.column(1), bits)):
                place = place + (model << bits)
                raw += np.bincount(place, minlength=size)
                good += np.bincount(place[is_target[row]], minlength=size)
        if some:
            on = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(raw[on]), pa.array(good[on])],
                                             names=["place", "raw", "target"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "place long, raw long, target long")
    out = rows.groupBy("place").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    shared.destroy()
    return out


def log_ratios(got: pa.Table, bits: int = BITS) -> np.ndarray:
    """Log ratio of each place of both models. Their size is fixed by ``bits``, so the driver may hold them."""
    out = np.zeros((2, 1 << bits), np.float32)
    place, raws, goods = (got[c].to_numpy() for c in ("place", "raw", "target"))
    for model in (0, 1):
        on = place >> bits == model
        raw, good = raws[on].astype(float), goods[on].astype(float)
        share = good.sum() / max(1.0, raw.sum())
        out[model, place[on] & ((1 << bits) - 1)] = np.log((good + SMOOTH) / (raw * share + SMOOTH))
    return out


def document_ratios(col: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """For each text: mean ratio, ratio of the weakest window of each size, log of the number of words.

    Bounded, so that far outliers weigh no more than clear cases.
    """
    (written, row, _), (low, low_row, first) = _grams(col, int(ratios.shape[1]).bit_length() - 1)
    n = len(col)
    out = [np.clip(np.bincount(row, weights=ratios[0][written], minlength=n) / np.maximum(1, np.bincount(row, minlength=n)), -1, 1)]
    sums = np.concatenate([[0.0], np.cumsum(ratios[1][low], dtype=np.float64)])
    for window in WINDOWS:
        weakest = sums[first[1:]] - sums[first[:-1]]  # of texts shorter than a window
        begin = W.inside_rows(first, window)
        if len(begin):
            of, cut = np.unique(low_row[begin], return_index=True)
            weakest[of] = np.minimum.reduceat(sums[begin + window] - sums[begin], cut)
        out.append(np.clip(weakest, -30, 5))
    return np.column_stack([*out, np.log1p(np.diff(first))])


def _noise(ids: np.ndarray, col: pa.Array, seed: int) -> np.ndarray:
    """Gumbel noise of each row, from its id, the length of its text and the seed."""
    length = np.diff(W.text_bytes(col)[1]).astype(np.uint64)
    h = W.mixed(W.mixed(ids.astype(np.uint64) + np.uint64(seed)) + length)
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    return -np.log(-np.log(u))


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic coefficients (constant first) by Newton steps with a small ridge."""
    mid, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mid) / spread])
    c = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(c)), z.T @ (y - p) - 1e-3 * c)
        c += step
        if np.abs(step).max() < 1e-8:
            break
    slope = c[1:] / spread
    return np.concatenate([[c[0] - slope @ mid], slope])


def _odds(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return c[0] + x @ c[1:]


def kth_largest(scores: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by histograms of ever finer bins (at most 4,096 rows reach the driver at a time)."""
    low, high = scores.agg(F.min(column), F.max(column)).first()
    if k <= 0 or low is None:
        return float("inf")
    bins, left = 4096, scores
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            return low
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        found = left.groupBy(place.alias("b")).agg(F.count("*"), F.min(column), F.max(column)).collect()
        for _, n, least, most in sorted(found, reverse=True):
            if k <= n:
                break
            k -= n
        if k == 1 and n:
            return most
        if k == n or least == most:
            return least
        low, high = least, most
        left = scores.filter(F.col(column).between(low, high))


@dataclass
class Quality:
    """A fitted classifier: documents whose key reaches ``threshold`` are drawn."""

    ratios: np.ndarray
    coefficients: np.ndarray
    threshold: float
    seed: int

    def keep(self, docs: DataFrame) -> DataFrame:
        """The drawn rows of ``docs``, all columns as they are."""
        shared = docs.sparkSession.sparkContext.broadcast((self.ratios, self.coefficients))
        threshold, seed, names = self.threshold, self.seed, docs.columns
        i, t = names.index("doc_id"), names.index("text")

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ratios, c = shared.value
            for b in W.text_slices(batches, t):
                odds = _odds(document_ratios(b.column(t), ratios), c)
                noise = _noise(_ids(b.column(i).cast(pa.int64())), b.column(t), seed)
                yield b.filter(pa.array(odds / TEMPERATURE + noise >= threshold))

        return docs.mapInArrow(work, docs.schema)


def ratio_rows(docs: DataFrame, ratios: np.ndarray, seed: int) -> DataFrame:
    """One row for each document: id, ratios and noise, written to the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.text_slices(batches, 1):
            x = document_ratios(b.column(1), shared.value)
            new = [pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.float64())),
                   pa.array(_noise(_ids(b.column(0)), b.column(1), seed))]
            yield pa.RecordBatch.from_arrays([b.column(0), *new], names=["doc_id", "x", "noise"])

    out = scratch_path(docs.sparkSession, "quality-ratios")
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, x array<double>, noise double").write.parquet(out)
    shared.destroy()
    return docs.sparkSession.read.parquet(out)


def fit_quality(docs: DataFrame, labels: DataFrame, seed: int = 11, bits: int = BITS, bound: int = LABELLED) -> tuple[Quality, DataFrame]:
    """The classifier, and the rows (doc_id, log_odds, sort_key, kept) of all documents. Reads the texts twice."""
    spark = docs.sparkSession
    known, target = labelled_rows(labels, bound)
    held = W.mixed(known.astype(np.uint64)) % np.uint64(FIT_SHARE) == 0
    ratios = log_ratios(gram_counts(docs, known[~held], target[~held], bits), bits)
    pa.default_memory_pool().release_unused()  # the counts are no longer held here
    rows = ratio_rows(docs, ratios, seed)
    told = spark.createDataFrame(list(zip(known[held].tolist(), target[held].tolist(), strict=True)), "doc_id long, target boolean")
    seen = rows.join(F.broadcast(told), "doc_id").groupBy("doc_id", "target").agg(F.min("x").alias("x")).toArrow()
    y = np.array(seen["target"].to_pylist(), bool)
    if not len(y) or y.all() or not y.any():
        c = np.zeros(2 + len(WINDOWS) + 1)
    else:
        c = fitted(np.array(seen["x"].to_pylist()), y.astype(float))
    odds = F.lit(float(c[0]))
    for i, w in enumerate(c[1:].tolist()):
        odds = odds + F.col("x")[i] * w
    rows = rows.select("doc_id", odds.alias("log_odds"), (odds / TEMPERATURE + F.col("noise")).alias("sort_key"))
    if c.any():
        k = rows.agg(F.sum(1 / (1 + F.exp(-F.col("log_odds"))))).first()[0] or 0
        threshold = kth_largest(rows, "sort_key", round(k))
        # A little lower, so that another order of rounding cannot part equal keys.
        threshold -= abs(threshold) * 1e-12
    else:
        threshold = float("-inf")
    return Quality(ratios, c, threshold, seed), rows.withColumn("kept", F.col("sort_key") >= threshold)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier draws."""
    model, _ = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.keep(docs)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its log odds, its sampling key and whether it is drawn."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))[1]
