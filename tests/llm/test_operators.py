"""Training-data operators against brute force on small frames with nulls, empty and repeated rows and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from canonix.llm import bpe, chat, decontaminate, lines, nearest, neardup, packing, quality, shard, shingles, substrings
from canonix.llm.components import components

DOCS = "doc_id long, text string, row long, n_hit string"


def _texts():
    rnd = random.Random(4)
    words = ["alpha", "Beta", "gamma", "délta", "eps.", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
    base = [" ".join(rnd.choice(words) + str(rnd.randint(0, 40)) for _ in range(60)) for _ in range(6)]
    near = base[0].split(" ")
    near[30] = "changed"
    return [*base, base[0], base[0], " ".join(near), base[1][:200] + "\n" + base[2][:200], "", None, None, "one", "  \t\n ",
            "same line of text here\nother\nsame line of text here", "same line of text hero\nlast", base[3] + "\n\n  x " * 3, "w " * 3000]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    texts = _texts()
    rows = [(None if i == 3 else i if i != 8 else 7, t, i, "x") for i, t in enumerate(texts)] + [(5, texts[5], 99, "y")]
    path = str(tmp_path_factory.mktemp("docs")) + "/d.parquet"
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none")) + "/d.parquet"
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)


def test_bpe_equals_the_library(docs, empty):
    import tiktoken

    path, pattern = bpe.public_vocabulary()
    vocab = bpe.vocabulary(path)
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocab["ranks"], special_tokens={})
    got = sorted((r["row"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in bpe.encode_documents(docs, digest="sha256", keep=("row",)).collect())
    want = sorted((r["row"], len(ids := known.encode_ordinary(r["text"] or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in docs.collect())
    assert got == want
    assert bpe.encode_documents(empty).count() == 0
    coder = bpe.Encoder(bpe.batch_tables(vocab), pattern)
    odd = ["a  b", "a\n b", "\n\n x", "x\n\n", "don't 12½", "日本語 \U0001f389", "a" * 700, " \t\n x's", "\x1c y z"]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(odd)] == [known.encode_ordinary(t) for t in odd]


def test_prefix_table_appends_and_edits():
    vocab = bpe.vocabulary(bpe.public_vocabulary()[0])
    rnd = random.Random(2)
    for _ in range(60):
        data = " ".join(rnd.choice(["token", "isation", "the", "zq"]) for _ in range(80)).encode()
        table, at = bpe.PrefixTable(vocab, data), rnd.randint(0, len(data))
        part = bpe.PrefixTable(vocab, data[:at])
        part.append(data[at:])
        assert part.last == table.last
        done = table.edit(at, min(len(data), at + 3), b"new")
        assert table.last == bpe.PrefixTable(vocab, data[:at] + b"new" + data[at + 3:]).last and done <= len(table.last)


def test_shards_are_even_and_gapless(docs, empty):
    got = shard.shard_rows(docs, 4).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == docs.count() and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard.shard_rows(empty).count() == 0
    again = shard.shard_rows(docs.filter("true"), 4).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


@pytest.mark.parametrize("n", [1, 2, 7, 41, 1000])
def test_permutation_is_one_to_one(spark, n):
    from pyspark.sql import functions as F

    steps = shard.walk_length(spark, n, 7)
    assert sorted(r[0] for r in spark.range(n).select(shard.permuted(F.col("id"), n, 7, steps)).collect()) == list(range(n))


def test_chat_folds_events_and_reads_back(spark):
    log = spark.createDataFrame(
        [(1, 1, "message", 0, "user", "hi </s>"), (1, 2, "message", 1, "assistant", "a"), (1, 3, "delta", 1, None, "b<|end|>"),
         (1, 4, "message", 2, "user", "gone"), (1, 5, "regenerate", 1, None, "new"), (1, 6, "delta", 1, None, " \\[INST]"),
         (1, 7, "edit", 0, None, "edited <\\|x"), (None, 1, "message", 0, None, None)],
        "conv_id long, seq long, kind string, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.final_messages(log))).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", "edited <\\|x"), ("assistant", "new \\[INST]")]
    assert got[1]["loss_text"] == "new \\[INST]" and [tuple(t) for t in got[None]["turns"]] == [("", "")]
    assert chat.render(chat.final_messages(log.limit(0))).count() == 0


def _jaccard_classes(sets, threshold):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and c >= threshold * (len(sets[i]) + len(sets[j]) - c) - 1e-9:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(sets))]


def test_near_classes_equal_brute_force(docs, empty):
    rows, _ = shard.numbered(docs, "__row")
    got = {r["row"]: r for r in neardup.near_classes(rows, block=2).collect()}
    texts = [r["text"] or "" for r in rows.orderBy("__row").collect()]
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else {t}))
    classes = _jaccard_classes(sets, 0.8)
    for i in range(len(texts)):
        for j in range(i):
            assert (classes[i] == classes[j]) == (got[i]["class"] == got[j]["class"]), (i, j)
    assert neardup.keep_one(docs).count() == len(set(classes))
    assert neardup.keep_one(docs).columns == docs.columns and neardup.keep_one(empty).count() == 0


def test_line_dedup_equals_brute_force(docs, empty):
    rows, _ = shard.numbered(docs, "__row")
    texts = [r["text"] for r in rows.orderBy("__row").collect()]
    each = [(r, i, x) for r, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]
    first = {}
    for k, (_, _, x) in enumerate(each):
        first.setdefault(x, k)
    names = list(first)
    classes = _jaccard_classes([{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in names], 0.8)
    keep = {x: first[names[c]] for x, c in zip(names, classes, strict=True)}
    gone = {(r, i) for k, (r, i, x) in enumerate(each) if keep[x] != k}
    want = [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r, i) not in gone) for r, t in enumerate(texts)]
    got = lines.dedup_lines(rows)
    assert [r["text"] for r in got.orderBy("__row").collect()] == want
    assert lines.dedup_lines(empty).count() == 0


def _line_pairs(common, more, trials):
    """Pairs of lines of Jaccard similarity 0.8: ``common`` shingles and, on each side, ``more`` of their own."""
    rnd = random.Random(common)
    chars = "abcdefghijklmnopqrstuvwxyz0123456789"
    for _ in range(trials):
        both = "".join(rnd.choice(chars) for _ in range(common + 7))
        yield [both + (mark + "".join(rnd.choice(chars) for _ in range(k - 1)) if k else "") for mark, k in zip("+-", more, strict=True)]


@pytest.mark.parametrize("common, more", [(4, (1, 0)), (8, (1, 1)), (16, (2, 2)), (32, (4, 4)), (120, (15, 15)), (400, (50, 50))])
def test_bands_find_short_lines_as_often_as_long_ones(common, more):
    x, y = (pa.array(side) for side in zip(*_line_pairs(common, more, 1500), strict=True))
    assert all(shingles.similar(x, y, 0.8))
    met = (shingles.keys_of(x) == shingles.keys_of(y)).any(axis=1)
    assert met.mean() > 0.98  # 1 - (1 - 0.8 ** 4) ** 9 = 0.991


def test_short_similar_lines_are_joined(spark):
    texts = [x for pair in _line_pairs(4, (1, 0), 400) for x in pair] + [x for pair in _line_pairs(8, (1, 1), 400) for x in pair]
    want = _jaccard_classes([{x[i:i + 8] for i in range(len(x) - 7)} for x in texts], 0.8)
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, line string").select("*", shingles.band_keys()("line").alias("keys"))
    got = {r["node"]: r["root"] for r in lines.similar_classes(rows).collect()}
    assert all(want[k] == want[v] for k, v in got.items())
    twins = [i for i, c in enumerate(want) if c != i]
    assert sum(got.get(i, i) == want[i] for i in twins) > 0.98 * len(twins)


def test_line_buckets_are_compared_whole(spark):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdefghij") for _ in range(120)) for _ in range(4)]
    # Chains of small changes: far ends of a chain are similar only by way of what lies between.
    texts = []
    for b in base:
        for k in range(12):
            texts.append(b[: 120 - 3 * k] + "".join(rnd.choice("xyz") for _ in range(3 * k)))
    rnd.shuffle(texts)
    want = _jaccard_classes([{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in texts], 0.8)
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, line string")
    members = rows.selectExpr("node", "1L AS key")
    none = spark.createDataFrame([], "node long, root long")
    known = spark.createDataFrame([(i, c) for i, c in enumerate(want) if i % 2], "node long, root long")
    for roots in (none, known):
        for block in (5, 1000):
            edges = lines._rest(members, roots, rows, 0.8, block).unionByName(roots.selectExpr("node AS a", "root AS b"))
            got = {r["node"]: r["root"] for r in components(edges).collect()}
            assert [got.get(i, i) for i in range(len(texts))] == want
    # One class needs no comparison.
    same = rows.selectExpr("node", "0L AS root")
    assert lines._rest(members, same, rows, 0.8, 5).count() == 0


def test_large_buckets_are_cut_and_lose_nothing(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(9)
    texts, base = [], "".join(rnd.choice("abcdefghij") for _ in range(200))
    for i in range(150):  # near copies of one line; others share four minima with it, but not 0.8
        cut = rnd.randint(0, 190)
        texts.append(base[:cut] + f"{i:06d}" + base[cut + 6:])
        if i % 5 == 0:
            texts.append(base[:130] + "".join(rnd.choice("xyz") for _ in range(70)))
    want = _jaccard_classes([{x[i:i + 8] for i in range(len(x) - 7)} for x in texts], 0.8)
    keys = shingles.band_keys()("line")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, line string").select("*", F.concat(F.slice(keys, 1, 8), F.array(F.lit(7).cast("long"))).alias("keys"))
    assert 7 in lines.hot_keys(rows, 8) and lines.hot_keys(rows.limit(0), 8) == []
    cut = lines._members(rows, 8).filter("key = 7")
    assert cut.select("piece").distinct().count() > 10
    assert {(r["n"], r["first"]) for r in cut.collect()} == {(len(texts), 0)}
    for piece in (8, 10 ** 6):
        got = {r["node"]: r["root"] for r in lines.similar_classes(rows, piece=piece).collect()}
        assert [got.get(i, i) for i in range(len(texts))] == want


def test_every_large_bucket_is_cut_whatever_else_there_is(spark):
    from pyspark.sql import functions as F

    # 60,000 lines, 9 keys each: 40 keys hold 21 to 60 lines in one band, all others are alone.
    size = {k: 21 + k for k in range(40)}
    large = [k for k, n in size.items() for _ in range(n)]
    rows = spark.range(60_000).select(F.col("id").alias("node"), F.transform(F.sequence(F.lit(0), F.lit(8)), lambda b: F.xxhash64("id", b)).alias("keys"))
    of = spark.createDataFrame(list(enumerate(large)), "node long, large long")
    rows = rows.join(of, "node", "left").select("node", F.when(F.col("large").isNull(), F.col("keys")).otherwise(
        F.concat(F.slice("keys", 1, 8), F.array("large"))).alias("keys"))
    assert lines.hot_keys(rows, 10) == list(size)
    got = lines._members(rows, 10).groupBy("key").agg(F.count_distinct("piece").alias("pieces"), F.count("*").alias("n"), F.max("n").alias("said"),
                                                      F.min("first").alias("first"), F.max("piece").alias("last")).collect()
    assert {r["key"]: (r["n"], r["said"], r["first"]) for r in got} == {k: (n, n, large.index(k)) for k, n in size.items()}
    assert all(r["pieces"] > 1 and r["last"] < -(-size[r["key"]] // 10) for r in got)


def test_shingle_sets_of_a_slice_are_those_of_its_lines():
    texts = ["aaaaaaaaaaaaaaaa", "", "abc", "abcabcabcabcabcabc", "aaaaaaaaaaaaaaaa", "x" * 8, "y" * 9 + "x" * 8, "é" * 30]
    for of, got in zip(texts, shingles._sets(pa.array(texts)), strict=True):
        h, _ = shingles.hashed(pa.array([of]))
        assert got.tolist() == sorted(set(h.tolist()))


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = [{a, b} for a, b in edges]
    for c in set(classes := _jaccard_classes(sets, 1e-6)):
        nodes = set().union(*(s for s, k in zip(sets, classes, strict=True) if k == c))
        if len(nodes) > 1:
            assert {got[n] for n in nodes} == {min(nodes)}


@pytest.mark.parametrize("bucket_rows", [1, 200_000])
def test_substring_dedup_equals_brute_force(docs, empty, bucket_rows):
    data = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()]
    least = {}
    for d, w in data:
        for i in range(len(w) - 12 if d is not None else 0):
            k = tuple(w[i:i + 13])
            least[k] = min(least.get(k, d), d)
    want = []
    for d, w in data:
        gone = {j for i in range(len(w) - 12 if d is not None else 0) if least[tuple(w[i:i + 13])] < d for j in range(i, i + 13)}
        want.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [tuple(r) for r in substrings.remove_repeats(docs, bucket_rows=bucket_rows).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert substrings.remove_repeats(empty).count() == 0


def test_substring_dedup_without_ids(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(20))
    path = str(tmp_path) + "/d"
    spark.createDataFrame([(None, text), (5, text), (None, text), (6, text)], "doc_id long, text string").coalesce(1).write.parquet(path)
    got = substrings.remove_repeats(spark.read.parquet(path)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (0, 0), (5, 0), (6, 20)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_decontamination_equals_brute_force(spark, docs, empty, block_bytes):
    base = [r["text"] for r in docs.collect()][0].split(" ")
    items = spark.createDataFrame([(1, " ".join(base[5:25]).upper()), (2, "one"), (None, " ".join(base[40:55])), (4, None), (2, "one"), (5, "no such")],
                                  "item_id long, text string")

    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = {tuple(w[i:i + min(13, len(w))]) for t in items.collect() if (w := cut(t["text"])) for i in range(len(w) - min(13, len(w)) + 1)}
    want = []
    for r in docs.collect():
        w = cut(r["text"])
        hit = {j for x in windows for i in range(len(w) - len(x) + 1) if tuple(w[i:i + len(x)]) == x for j in range(i, i + len(x))}
        want.append((r["row"], len(w), len(hit)))
    found = decontaminate.find_hits(docs, items, block_bytes=block_bytes)
    got = found.select("row", "__n_words", decontaminate._covered(found["__hits"])).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    kept = decontaminate.decontaminate(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns and kept.count() == sum(not (h and 20 * h >= n) for _, n, h in want)
    assert decontaminate.decontaminate(empty, items).count() == 0 and decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_repeated_items_do_not_fill_a_block(spark, docs):
    base = docs.first()["text"].split(" ")
    items = spark.createDataFrame([(1, " ".join(base[5:25]))] * 500 + [(i, f"item {i}") for i in (2, 3, None)], "item_id long, text string")
    blocks = [b.collect() for b in decontaminate._blocks(items, 2000)]
    assert sum(len(r["text"]) for r in max(blocks, key=len)) <= 2000
    assert {tuple(r) for b in blocks for r in b} == {tuple(r) for r in items.collect()}
    found = [decontaminate.find_hits(docs, i, block_bytes=2000).select("row", "__n_words", "__hits").collect() for i in (items, items.distinct())]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1])) and any(r["__hits"] for r in found[0])


def test_packing_is_lossless(docs, empty):
    import tiktoken

    path, pattern = bpe.public_vocabulary()
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.vocabulary(path)["ranks"], special_tokens={})
    pieces = []
    for r in packing.pack_documents(docs, row=64).collect():
        ids, at = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == 64
        for d, k, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            assert at[a:b].tolist() == list(range(b - a))
            pieces.append((d, k, tuple(ids[a:b].tolist())))
    want = []
    for r in docs.collect():
        ids = [*known.encode_ordinary(r["text"] or ""), 50256]
        want += [(r["doc_id"], k, tuple(ids[lo:lo + 64])) for k, lo in enumerate(range(0, len(ids), 64))]
    assert sorted(pieces, key=str) == sorted(want, key=str)
    assert packing.pack_documents(empty).count() == 0
    sizes = np.random.default_rng(0).integers(1, 65, 500)
    rows = packing.best_fit(sizes, 64)
    assert sorted(i for r in rows for i in r) == list(range(500)) and max(sizes[r].sum() for r in rows) <= 64


def test_packed_lines_are_files(docs, empty, tmp_path):
    from pyspark.errors import PySparkException

    out = str(tmp_path / "packed")
    manifest = packing.write_packed(docs, out, row=64)
    want = packing.pack_documents(docs, row=64).orderBy("shard", "line").collect()
    assert packing.read_packed(manifest).orderBy("shard", "line").collect() == want
    for m in manifest.collect():
        mine = [r for r in want if r["shard"] == m["shard"]]
        assert m["lines"] == len(mine) and m["width"] == 64
        for name in ("input_ids", "position_ids"):
            matrix = np.fromfile(f"{m['folder']}/{name}", m["kind"]).reshape(-1, 64)
            assert matrix.tobytes() == b"".join(r[name] for r in mine)
        assert np.fromfile(f"{m['folder']}/cu_seqlens", "<i4").tolist() == [x for r in mine for x in r["cu_seqlens"]]
    # What another attempt left is not read; what is cut short is told.
    (tmp_path / "packed" / "shard-00000-999999").mkdir()
    assert packing.read_packed(manifest).count() == len(want)
    with open(f"{m['folder']}/position_ids", "r+b") as f:
        f.truncate(10)
    with pytest.raises(PySparkException, match="bytes early"):
        packing.read_packed(manifest).collect()
    assert packing.read_packed(packing.write_packed(empty, str(tmp_path / "none"))).count() == 0


def test_nearest_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 24)).astype(np.float32)
    x[100:160] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 24), (2200, [float("nan")] * 24), (None, x[1].tolist()),
                                                         (3000, [1.0, 2.0]), (3001, [1.0, 3.0])]
    found = nearest.nearest_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.pop(3000) == [(3001, 1.0)] and sorted(got) == list(range(0, 900, 100))
    hit, y = 0, x.astype(float)
    for q, near in got.items():
        far = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.lexsort([np.arange(900), far])[:10].tolist()
        hit += len(set(best) & {i for i, _ in near})
        assert np.allclose([far[i] for i, _ in near], [s for _, s in near], rtol=1e-12, atol=0)
    assert hit >= 0.9 * 10 * len(got) and [i for i, _ in got[0]] == list(range(100, 110))


@pytest.mark.parametrize("clusters", [40, 0])
def test_probes_follow_the_measured_recall(spark, monkeypatch, clusters):
    rng = np.random.default_rng(11)
    n, d, lists = 4000, 16, 64
    x = rng.standard_normal((n, d))
    if clusters:
        x = x * 0.05 + rng.standard_normal((clusters, d))[rng.integers(0, clusters, n)]
    used = []
    needed = nearest.needed_probes
    monkeypatch.setattr(nearest, "needed_probes", lambda *a: used.append(needed(*a)) or used[-1])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest.nearest_vectors(vectors, lists=lists).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(got) == list(range(0, n, 100))
    hit = 0
    for q, near in got.items():
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        hit += len(near & set(np.lexsort([np.arange(n), far])[:10].tolist()))
    assert hit >= 0.95 * 10 * len(got)
    # Clusters need the least number of lists; vectors without structure many, but not all.
    assert used == [nearest.LEAST_PROBES] if clusters else nearest.LEAST_PROBES < used[0] < lists


def test_true_neighbours_of_measured_queries(spark):
    x = np.array([[0, 0], [1, 0], [0, 3], [5, 5], [5, 5], [1e200, 0]])
    rows = [(i % 3, 10 + i, v.tobytes(), i) for i, v in enumerate(x)]
    indexed = spark.createDataFrame(rows, "list long, vec_id long, x binary, row long").repartition(3)
    true = nearest._true_neighbours(indexed, x[[0, 3]], np.array([0, 3]), 2)
    assert sorted(zip(true["query"].to_pylist(), true["list"].to_pylist())) == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_nearest_of_repeated_ids_and_large_values(spark):
    big = [[1.0, 0.0], [2e200, 0.0], [4e200, 1e200], [1.0, 1e-200]]
    rows = [(100, big[0]), (100, big[1]), (7, big[2]), (3, big[3])]
    found = nearest.nearest_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    far = np.hypot(2e200, 1e200)
    want = [(100, 1, 3, 1e-200), (100, 1, 3, 2e200), (100, 2, 100, 2e200), (100, 2, 100, 2e200), (100, 3, 7, np.hypot(4e200, 1e200)), (100, 3, 7, far)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-12, atol=0)
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert nearest.nearest_vectors(none).count() == 0


def test_quality_keeps_clean_and_drops_toxic(spark):
    rnd = random.Random(5)
    words, bad = [f"word{i}" for i in range(300)], [f"slur{i}" for i in range(5)]
    rows, labels = [], []
    for i in range(900):
        w = [rnd.choice(words) for _ in range(rnd.randint(30, 80))]
        kind = i % 4
        if kind == 1:
            w = [x + rnd.choice(["***", "%%%"]) for x in w]
        elif kind == 2:
            w[::9] = [rnd.choice(bad) for _ in w[::9]]
        rows.append((i, " ".join(w)))
        if i < 600:
            labels.append((i, 0 if kind == 1 else 1, int(kind == 2)))
    rows += [(None, None), (900, ""), (900, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model, scored = quality.fit_quality(docs, labels, bits=14)
    kept = {r["doc_id"] for r in model.keep(docs).collect()}
    assert kept == {r["doc_id"] for r in scored.filter("kept").collect()}
    held = range(600, 900)
    assert sum((i in kept) == (i % 4 in (0, 3)) for i in held) >= 0.95 * len(held)
    keys = sorted((r["sort_key"] for r in scored.collect()), reverse=True)
    assert quality.kth_largest(scored, "sort_key", 100) == keys[99]
    assert quality.fit_quality(docs.limit(0), labels, bits=14)[1].count() == 0
    assert quality.fit_quality(docs, labels.limit(0), bits=14)[0].keep(docs).count() == docs.count()
