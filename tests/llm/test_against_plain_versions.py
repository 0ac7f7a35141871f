"""Scores, packing and the queries themselves against plain Python versions."""

import hashlib
import re
import zlib
from collections import Counter
from math import exp, log

import numpy as np
import pytest

from canonix.llm import bpe, nearest, packing, quality, shard
from canonix.llm import words as W

WORDS = ["Alpha", "alpha", "beta,", "Gamma", "slur", "delta-x", "***", "mu"]


def _ratios(texts, target, lowered):
    """{gram: log ratio} over the grams of each text, as strings."""
    grams = [_grams(t, lowered) for t in texts]
    raw = Counter(g for gs in grams for g in gs)
    good = Counter(g for gs, is_target in zip(grams, target, strict=True) if is_target for g in gs)
    share = sum(good.values()) / max(1, sum(raw.values()))
    return {g: float(np.float32(log((good[g] + 2) / (n * share + 2)))) for g, n in raw.items()}


def _grams(text, lowered):
    if lowered:
        return re.findall(r"[0-9a-z]+", (text or "").lower())
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return words + list(zip(words, words[1:]))


def _features(text, written, low):
    grams, words = _grams(text, False), [low[w] for w in _grams(text, True)]
    x = [min(1, max(-1, sum(written[g] for g in grams) / max(1, len(grams))))]
    for n in (4, 16):
        windows = [sum(words[i:i + n]) for i in range(len(words) - n + 1)] or [sum(words)]
        x.append(min(5, max(-30, min(windows))))
    return [*x, log(1 + len(words))]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(160):
        p = np.array([4, 4, 4, 4, 0.3, 4, 0.3, 4]) if i % 3 else np.array([1, 1, 1, 1, 4, 1, 4, 1])
        rows.append((i, " ".join(rng.choice(WORDS, rng.integers(1, 40), p=p / p.sum()))))
    rows += [(160, None), (161, ""), (None, "alpha mu"), (162, rows[5][1])]
    labels = [(i, int(i % 3 != 0), int(i % 9 == 0)) for i in range(0, 120)] + [(7, 0, 0), (None, 1, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, labels


def test_quality_scores_equal_plain_python(spark, corpus):
    path, rows, labels = corpus
    docs, told = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    model, scored = quality.fit_quality(docs, told)
    target = {}
    for i, good, toxic in labels:
        if i is not None:
            target[i] = target.get(i, True) and good == 1 and not toxic
    held = {i for i in target if int(W.mixed(np.array([i], np.uint64))[0]) % quality.FIT_SHARE == 0}
    counted = [target.get(i, False) and i not in held for i, _ in rows]
    texts = [t for _, t in rows]
    written, low = _ratios(texts, counted, False), _ratios(texts, counted, True)
    x = {r: _features(t, written, low) for r, t in enumerate(texts)}
    # The coefficients are where the penalized likelihood of the held labelled rows is flat.
    mine = [r for r, (i, _) in enumerate(rows) if i in held]
    fit, y = np.array([x[r] for r in mine]), np.array([target[rows[r][0]] for r in mine], float)
    z = np.column_stack([np.ones(len(fit)), (fit - fit.mean(axis=0)) / (fit.std(axis=0) + 1e-9)])
    slope = model.coefficients[1:] * (fit.std(axis=0) + 1e-9)
    c = np.concatenate([[model.coefficients[0] + model.coefficients[1:] @ fit.mean(axis=0)], slope])
    assert np.abs(z.T @ (y - 1 / (1 + np.exp(-z @ c))) - 1e-3 * c).max() < 1e-5
    # Log odds, noise, number drawn and threshold of every document.
    odds = [model.coefficients[0] + float(np.dot(model.coefficients[1:], x[r])) for r in range(len(rows))]
    keys = []
    for (i, text), o in zip(rows, odds, strict=True):
        seed = np.array([np.iinfo(np.int64).min if i is None else i]).astype(np.uint64) + np.uint64(model.seed)
        h = int(W.mixed(W.mixed(seed) + np.uint64(len((text or "").encode())))[0])
        keys.append(o / quality.TEMPERATURE - log(-log(((h >> 11) + 0.5) / 2 ** 53)))
    k = round(sum(1 / (1 + exp(-o)) for o in odds))
    drawn = {r for r in np.argsort(keys)[::-1][:k].tolist()}
    assert 0 < k < len(rows)
    got = sorted((str(r["doc_id"]), r["log_odds"], r["sort_key"], r["kept"]) for r in scored.collect())
    want = sorted((str(i), odds[r], keys[r], r in drawn) for r, (i, _) in enumerate(rows))
    assert [(g[0], g[3]) for g in got] == [(w[0], w[3]) for w in want]
    assert np.allclose([g[1:3] for g in got], [w[1:3] for w in want], rtol=1e-5, atol=1e-5)
    again = {r["doc_id"] for r in quality.op3_quality_classifier(spark, path).filter("kept").collect()}
    assert again == {rows[r][0] for r in drawn}


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_best_fit_decreasing(seed):
    capacity = 50
    sizes = np.random.default_rng(seed).integers(1, capacity + 1, 300)
    room = []
    for size in sorted(sizes.tolist(), reverse=True):  # each into the row with the least room that holds it
        fits = [r for r in room if r >= size]
        if fits:
            room.remove(min(fits))
        room.append(min(fits, default=capacity) - size)
    assert sorted(capacity - sizes[r].sum() for r in packing.best_fit(sizes, capacity)) == sorted(room)


def test_sharding_query(spark, corpus):
    path, rows, _ = corpus
    got = shard.op7_sharding(spark, path).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got) == want
    places = sorted(r["slot"] * 40 + r["shard"] for r in got)
    assert places == list(range(len(rows)))  # 0 to 39 in turn, without gaps: counts differ by one at most


def test_encoding_query(spark, corpus):
    import tiktoken

    path, rows, _ = corpus
    file, pattern = bpe.public_vocabulary()
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.vocabulary(file)["ranks"], special_tokens={})
    want = Counter()
    for i, t in rows:
        ids = known.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = bpe.op2_byte_bpe(spark, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, got)) == want


def test_nearest_query_scans_all_of_a_few(spark, tmp_path):
    x = np.random.default_rng(1).standard_normal((230, 6)).astype(np.float32).astype(float)
    x[150] = x[30]
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = []
    for q in (0, 100, 200):
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        others = [j for j in np.lexsort([np.arange(len(x)), far]).tolist() if j != q][:10]
        want += [(q, n, j, far[j]) for n, j in enumerate(others, 1)]
    got = sorted(map(tuple, nearest.op9_nearest_neighbours(spark, str(tmp_path)).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)
