"""Source mixing, phrase mining and resampling against brute force, with nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from canonix.llm import mixing, phrases, resample, trie

DOCS = "doc_id long, text string, source string, lang string, size string, rank int, `row` int, n string, __file string, copy int"


def _rows():
    rnd = random.Random(9)
    words = ["alpha", "Beta", "gamma", "délta", "ab", "c", "a\x01b", "zeta", "eta", "x1"]
    out = []
    for i in range(400):
        text = " ".join(rnd.choice(words[:2 + i % 9]) + rnd.choice(["", "", "", ",", ". ", "\n", "-", " \t"]) for _ in range(rnd.randint(1, 60)))
        source = "hot" if i % 3 else rnd.choice(["a", "b", None, "z", "é", "hot"])
        out.append((i, text, source, rnd.choice(["en", "de", None, "und"]), "own", 5, i, "n", "f", 1))
    out += [(400, "", "a", "en", "own", 5, 400, "n", "f", 1), (401, None, "b", None, None, None, None, None, None, None),
            (None, "no id here", "a", "en", "own", 5, 402, "n", "f", 1), (403, "alpha beta gamma " * 4000, "long", "en", "own", 5, 403, "n", "f", 1),
            (404, "  \t \n", "none", "xx", "own", 5, 404, "n", "f", 1), (405, "퟿\U0001f389 Ünï ALPHA", "a", "en", "own", 5, 405, "n", "f", 1)]
    return out + [out[7]] * 5 + [(7, out[8][1], "hot", "en", "own", 5, 7, "n", "f", 1)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mix")) + "/d.parquet"
    spark.createDataFrame(_rows(), DOCS).repartition(7).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none")) + "/d.parquet"
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(size, cap=3):
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(size.values()) - cap * sum(size[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        share = {s: Fraction(left * weight[s], rest) for s in names if s not in capped}
        above = {s for s in share if share[s] > cap * size[s]}
        if not above:
            return share | {s: Fraction(cap * size[s]) for s in capped}
        capped |= above


def test_mix_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    size = Counter()
    for _, text, source in rows:
        size[source] += _size(text)
    target, groups = _targets(size), defaultdict(list)
    for doc_id, text, source in rows:
        tie = hashlib.md5(f"2024:{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
        groups[source].append((_size(text), tie, doc_id))
    want = []
    for source, mine in groups.items():
        name = "2024" if source is None else f"2024:{source}"
        u = Fraction(int(hashlib.sha256(name.encode()).hexdigest()[:15], 16), 1 << 60)
        each = target[source] / size[source] if size[source] else 0
        total = u
        for words, _, doc_id in sorted(mine, key=lambda x: x[:2]):
            n = math.floor(total + each) - math.floor(total)
            total += each
            want.append((str(doc_id), words, size[source], float(target[source]), n))
    got = mixing.mix_copies(docs, keep=["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"], r["target"], r["copies"]) for r in got) == sorted(want)


def test_mix_stays_near_its_targets(docs, spark):
    for seed in (1, 2, 3):
        taken, target, largest = Counter(), {}, Counter()
        for r in mixing.mix_copies(docs, keep=["source"], seed=seed).collect():
            assert 0 <= r["copies"] <= 3
            taken[r["source"]] += r["copies"] * r["size"]
            target[r["source"]] = r["target"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert target["none"] == 0 and taken["none"] == 0


def test_mix_documents_emits_each_copy(docs, empty):
    copies = Counter()
    for r in mixing.mix_copies(docs, keep=["doc_id", "text", "row"]).collect():
        copies[r["doc_id"], r["text"], r["row"]] += r["copies"]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == ["doc_id", "text", "source", "lang", "rank", "row", "n", "__file", "copy"]
    assert Counter((r["doc_id"], r["text"], r["row"]) for r in mixed.collect()) == +copies
    assert mixing.mix_copies(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_sources_all_without_words(spark):
    rows = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["target"], r["copies"]) for r in mixing.mix_copies(rows).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


@pytest.mark.parametrize("words", [450_000_000, 2_000_000_000, 3_000_000_000_000_000_000])
def test_targets_of_many_words(spark, words):
    """A weight times all words does not fit the type that holds all words."""
    size = {"a": words // 2, "b": words // 4, "c": words // 8, None: words // 16}
    sizes = spark.createDataFrame(list(size.items()), "source string, source_size long")
    got = mixing.source_targets(sizes).collect()
    assert {r["source"]: r["target"] for r in got} == {s: float(t) for s, t in _targets(size).items()}
    assert {r["source"]: Fraction(int(r["share"]), int(r["shares"])) * size[r["source"]] for r in got} == _targets(size)


def _phrases(rows, least, longest=5, top=None):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        mine = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(mine), 1):
            if top is None or rank <= top:
                out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("options", [{}, {"top": 20}, {"vocabulary_bytes": 60, "trie_phrases": 7}, {"longest": 3}, {"longest": 2, "vocabulary_bytes": 90}])
def test_phrases_equal_brute_force(docs, options):
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    least = 8
    got = phrases.mine_phrases(docs, least=least, **({"top": None} | options))
    want = _phrases(rows, least, options.get("longest", 5), options.get("top"))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want
    assert len(want) > 20


def test_phrases_in_slices_and_stretches(docs, monkeypatch):
    batch = docs.select("lang", "text").toArrow().combine_chunks().to_batches()
    whole = Counter()
    for size in (8 << 20, 700, 1):
        found = Counter()
        for lang, data in phrases.slices(batch, size):
            words, ends = phrases.split_words(data)
            piece = []
            for w, e in zip(words.to_pylist(), ends.tolist(), strict=True):
                piece.append(w)
                if e:
                    found[lang, tuple(piece)] += 1
                    piece = []
            assert not piece
        whole = whole or found
        assert found == whole
    number = np.array([0, 1, 2, -1, 3, 4, 5, 6, 0], np.int32)
    ends = np.array([0, 1, 0, 0, 0, 0, 0, 0, 1], bool)
    monkeypatch.setattr(phrases, "STRETCH", 3)
    found = Counter()
    for starts, x in phrases._stretches(number, ends, 3):
        got, n = phrases.candidates(np.frombuffer(x, np.int32), starts, 2, None, True, 10)
        found.update(dict(zip(got.tolist(), n.tolist(), strict=True)))
    assert found == Counter([1, 34, 45, 56, 60])
    rnd = np.random.default_rng(5)
    parts = [np.unique(rnd.integers(0, 50, 20), return_counts=True) for _ in range(30)]
    want = Counter()
    for key, n in parts:
        want.update(dict(zip(key.tolist(), n.tolist(), strict=True)))
    for limit in (1, 7, 30, 1000):
        found = Counter()
        for key, n in phrases.summed(parts, limit):
            found.update(dict(zip(key.tolist(), n.tolist(), strict=True)))
        assert found == want


def test_phrases_of_none(empty, docs):
    assert phrases.mine_phrases(empty).count() == 0
    assert phrases.mine_phrases(docs, least=10 ** 9).count() == 0


def test_trie_accepts_its_phrases_only():
    rnd = np.random.default_rng(3)
    for symbols, count, depth in ((5, 40, 2), (50, 5000, 3), (3000, 20000, 4), (1, 1, 1)):
        rows = np.unique(np.minimum(rnd.zipf(1.3, (count, depth)) - 1, symbols - 1).astype(np.int32), axis=0)
        rnd.shuffle(rows)
        built = trie.build(rows, symbols)
        asked = np.vstack([rows, rnd.integers(-1, symbols, (count, depth)).astype(np.int32)])
        state = np.zeros(len(asked), np.int64)
        for j in range(depth):
            state = built.step(state, asked[:, j].astype(np.int64))
        row = {tuple(p): i for i, p in enumerate(rows.tolist())}
        assert [int(built.accepts[s]) if s >= 0 else -1 for s in state] == [row.get(tuple(p), -1) for p in asked.tolist()]


def _resampled(rows, aim, n, buckets, least_words, percent):
    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]

    found = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = Counter(b for *_, f in found for b in f), Counter(b for text in aim for b in features(text)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    out, fit = [], []
    for i, (doc_id, words, f) in enumerate(found):
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in f)
        weight = gain // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None])
        if words >= least_words:
            fit.append((-score, math.inf if doc_id is None else doc_id, i))
    for rank, (*_, i) in enumerate(sorted(fit)[:percent * len(fit) // 100], 1):
        out[i][4] = rank
    return sorted(map(str, out))


@pytest.mark.parametrize(("n", "buckets", "percent"), [(1, 10_000, 10), (3, 70_000, 50), (2, 7, 100)])
def test_resampling_equals_brute_force(docs, n, buckets, percent):
    aim = docs.filter("doc_id % 5 = 0")
    want = _resampled([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in aim.collect()], n, buckets, 20, percent)
    got = resample.resample(docs, aim, keep=["doc_id"], n=n, buckets=buckets, percent=percent).collect()
    assert sorted(str([r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")]) for r in got) == want


def test_resampling_keeps_columns_and_takes_empty_tables(docs, empty):
    drawn = resample.drawn_documents(docs, empty)
    assert drawn.columns == [*[c for c in docs.columns if c != "rank"], "n_features", "weight", "score", "rank"]
    ranks = sorted(r["rank"] for r in drawn.collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
    assert resample.resample(empty, docs).count() == 0
    assert resample.resample(empty, empty).count() == 0
