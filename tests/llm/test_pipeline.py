"""The corpus pipeline's chain on a small corpus: each stage's rows against brute force over its real input."""

import math
import random
import re

import numpy as np

import corpus_pipeline
from canonix.llm import bpe, quality, shard
from tests.llm.test_operators import _jaccard_classes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _tables(spark, out):
    rnd = random.Random(8)
    words, bad = [f"word{i}" for i in range(250)], [f"slur{i}" for i in range(5)]
    texts, labels = [], []
    for i in range(240):
        w = [rnd.choice(words) for _ in range(rnd.randint(60, 90))]
        if i % 4 == 1:
            w = [x + rnd.choice(["***", "%%%"]) for x in w]
        elif i % 4 == 2:
            w[::9] = [rnd.choice(bad) for _ in w[::9]]
        if i < 180:
            labels.append((i, 0 if i % 4 == 1 else 1, int(i % 4 == 2)))
        texts.append("\n".join(" ".join(w[k:k + 20]) for k in range(0, len(w), 20)))
    foot = "all rights are reserved by the owner of this page in the year 200"
    for i in range(0, 240, 12):  # a line of near copies
        texts[i] += f"\n{foot}{i % 7}"
    # Copies whose lines are cut elsewhere stay for the join; a passage of the benchmark in two texts.
    for i in (180, 184, 188):
        w = texts[i].replace("\n", " ").split(" ")
        w[40] = "changed"
        texts += ["\n".join(" ".join(w[k:k + 13]) for k in range(0, len(w), 13)), texts[i]]
    item = " ".join(rnd.choice(words) for _ in range(18))
    texts[204] += "\n" + item.upper()
    texts[208] = item + "\n" + texts[208]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(None, texts[3] + " end", "en", "s", 1), (990, None, None, "s", None)]
    sf = str(out)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3, "source").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf


def _rows(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in docs.collect()), key=str)


def _in_order(docs):
    return [tuple(r[c] for c in COLUMNS) for r in shard.numbered(docs, "__row")[0].orderBy("__row").collect()]


def _good(docs, labels):
    """Scores are the module's; the draw of the k best is brute force."""
    scored = quality.fit_quality(docs, labels)[1].collect()
    k = round(sum(1 / (1 + math.exp(-r["log_odds"])) for r in scored))
    drawn = sorted((r["sort_key"], r["doc_id"] is None, r["doc_id"] or 0) for r in scored)[len(scored) - k:]
    ids = {None if null else i for _, null, i in drawn}
    return [r for r in _in_order(docs) if r[0] in ids]


def _without_lines(rows):
    each = [(r, i, x) for r, t in enumerate(rows) if t[1] is not None for i, x in enumerate(t[1].split("\n")) if x.strip(" \t\r\x0b\x0c")]
    first = {}
    for k, (_, _, x) in enumerate(each):
        first.setdefault(x, k)
    names = list(first)
    classes = _jaccard_classes([{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in names], 0.8)
    keep = {x: first[names[c]] for x, c in zip(names, classes, strict=True)}
    gone = {(r, i) for k, (r, i, x) in enumerate(each) if keep[x] != k}
    out = []
    for r, (d, t, lang, source, _) in enumerate(rows):
        t = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r, i) not in gone)
        out.append((d, t, lang, source, None if t is None else len(t)))
    return out


def _one_of_each(rows):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {r[1] or ""})
    least = {}
    for i, c in enumerate(_jaccard_classes(sets, 0.8)):
        least.setdefault(c, []).append((rows[i][0] is None, rows[i][0] or 0, i))
    return [rows[min(v)[2]] for v in least.values()]


def _clean(rows, items):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())

    windows = {tuple(w[i:i + 13]) for t in items if (w := cut(t)) for i in range(len(w) - 12)}
    out = []
    for r in rows:
        w = cut(r[1])
        hit = {j for i in range(len(w) - 12) if tuple(w[i:i + 13]) in windows for j in range(i, i + 13)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def test_every_stage_equals_brute_force(spark, tmp_path, monkeypatch):
    import tiktoken

    sf, seen = _tables(spark, tmp_path), []

    def watched(stage):
        def run(s, docs, d):
            seen.append(docs)
            return stage(s, docs, d)

        return run

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(f)) for n, f in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, sf)
    raw, good, lines, single, clean = seen
    assert all(d.columns == COLUMNS for d in seen)
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert _rows(good) == sorted(_good(raw, labels), key=str)
    assert _rows(lines) == sorted(_without_lines(_in_order(good)), key=str)
    assert _rows(single) == sorted(_one_of_each(_in_order(lines)), key=str)
    assert _rows(clean) == sorted(_clean(_in_order(single), items), key=str)
    # Each stage had something to do.
    counts = [d.count() for d in seen]
    assert counts[0] > counts[1] and counts[2] > counts[3] > counts[4] > 0 and _rows(good) != _rows(lines)
    path, pattern = bpe.public_vocabulary()
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.vocabulary(path)["ranks"], special_tokens={})
    assert last.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]
    want = [(d, lang, source, n, len(ids := known.encode_ordinary(t or "")), np.array(ids, "<u4").tobytes()) for d, t, lang, source, n in _in_order(clean)]
    assert sorted(((*r[:5], bytes(r[5])) for r in last.collect()), key=str) == sorted(want, key=str)
