r"""Phrase collocation mining, level by level, with broadcast double-array tries.

Texts (A-Z lowered) are split at ``[.,;:!?\x0A-\x0D]`` into pieces and those into words ``[^\x20\x09]+``; counts
are per language, with null as ``und``. Words are counted first. Frequent words are numbered and the texts written once
as numbers, with a break between pieces and in place of any other word: a phrase with a rare word
is rare itself. Level k then finds the frequent phrases of k words: the trie of the frequent phrases of k - 1
words is broadcast, numpy advances the states of all positions of a shard together, one word a level, and the
candidates are the positions whose first k - 1 words and last k - 1 words are both accepted (Apriori). Their pairs of
accepting state and next word are counted in the shard and added up in the task, and Spark sums the tasks' counts. Candidates are thus those that occur, so
no pairs of words are made that stand nowhere.

Scores are exact (whole decimals): each candidate is cut after each word, joined to both parts' counts, and its lowest-scoring
cut counts. A candidate goes if a longer one of one more word has as high a share of its count; one of
two more words then has it in between.

Bounds: vocabulary and tries go to the tasks in blocks of ``VOCABULARY_BYTES`` of words and ``TRIE_PHRASES`` phrases at most on average
(dealt by hash); more of them mean more passes, over texts and over numbers. Each phrase's first k - 1 words are in one
block, so each phrase is counted by one pass; with several blocks the last k - 1 words are not tested, which only
counts more candidates in vain. Long texts are cut at piece ends to ``SLICE`` bytes, as pieces do not know each other. Defined results: null and empty texts have no words;
null languages and ``und`` are one; repeated documents count again; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.llm import trie
from canonix.llm import words as W
from canonix.llm.places import placed, written

LEAST = 100
LONGEST = 5
TOP = 2000
SLICE = 4 << 20
#: Numbers in a written row.
STRETCH = 1 << 18
#: Different candidates that a task holds before it sends them.
HELD = 1 << 19
VOCABULARY_BYTES = 64 << 20
TRIE_PHRASES = 2 << 20
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_WORD = ~_BREAK
_WORD[[32, 9]] = False


def _cut(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bytes in slices that end at a piece's end, of ``size`` unless a piece is longer."""
    lo = 0
    while lo < len(data):
        hi = min(lo + size, len(data))
        if hi < len(data):
            ends = np.flatnonzero(_BREAK[data[lo:hi]])
            at = hi
            while not len(ends) and at < len(data):
                ends = at - lo + np.flatnonzero(_BREAK[data[at:at + size]])[:1]
                at += size
            hi = lo + int(ends[-1]) + 1 if len(ends) else len(data)
        yield data[lo:hi]
        lo = hi


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE) -> Iterator[tuple[str, np.ndarray]]:
    """(language, lowered bytes) of rows (lang, text), rows parted by a line break."""
    for b in W.text_slices(batches, 1, size):
        for lang in pc.unique(b.column(0)).to_pylist():
            data, off = W.text_bytes(b.column(1).filter(pc.equal(b.column(0), lang)))
            for part in _cut(np.insert(W.lowered(data), off[1:-1], np.uint8(10)), size):
                yield lang, part


def split_words(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, whether a piece ends after the word)."""
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    ws, we = edge[::2], edge[1::2]
    off = np.concatenate([[0], np.cumsum(we - ws)])
    words = pa.LargeStringArray.from_buffers(len(ws), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[inside].tobytes()))
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    return words, breaks[np.append(ws[1:], len(data))] + (np.arange(len(ws)) == len(ws) - 1) > breaks[we]


def _of_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL")


def word_counts(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) of the frequent words, and (lang, n) of all."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in slices(batches):
            words = split_words(data)[0].dictionary_encode()
            n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            some = pa.concat_arrays([words.dictionary.cast(pa.string()), pa.array([None], pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), some, pa.array(np.append(n, n.sum()))], names=["lang", "word", "n"])

    counts = texts.mapInArrow(work, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter((F.col("n") >= least) | F.col("word").isNull()), "phrase-words")
    return counts.filter("word IS NOT NULL"), counts.filter("word IS NULL").select("lang", "n")


def _numbers(data: np.ndarray, known: pa.Array, number: np.ndarray, so_far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word or -1, whether a piece ends after it)."""
    words, ends = split_words(data)
    i = pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    found = np.where(i >= 0, number[i], -1).astype(np.int32) if len(number) else np.full(len(words), -1, np.int32)
    return (found if so_far is None else np.maximum(found, so_far)), ends


def _stretches(number: np.ndarray, ends: np.ndarray, longest: int) -> Iterator[tuple[int, bytes]]:
    """(starts, numbers): -1 stands for breaks; words without a neighbour go. The last ``longest - 1`` numbers are for phrases that start before."""
    out = np.full(2 * len(number), -1, np.int32)
    out[::2] = number
    keep = np.ones(len(out), bool)
    keep[1::2] = ends
    out = out[keep]
    on = out >= 0
    beside = np.zeros(len(out), bool)
    beside[1:] = on[:-1]
    beside[:-1] |= on[1:]
    out = np.where(on & beside, out, -1)
    out = out[(out >= 0) | np.concatenate([[False], out[:-1] >= 0])]
    for lo in range(0, len(out), STRETCH):
        part = out[lo:lo + STRETCH + longest - 1]
        yield min(STRETCH, len(out) - lo), part.tobytes()


def _blocks(rows: DataFrame, total: int, limit: int, *key: str) -> list[DataFrame]:
    n = -(-total // limit) or 1
    return [rows] if n == 1 else [rows.filter(F.pmod(F.xxhash64(*key), F.lit(n)) == i) for i in range(n)]


def numbered_texts(texts: DataFrame, words: DataFrame, longest: int, vocabulary_bytes: int) -> DataFrame:
    """(starts, numbers) of all texts; ``words`` (lang, word, id)."""
    context = texts.sparkSession.sparkContext
    total = words.agg(F.sum(F.octet_length("word") + 16)).first()[0] or 0
    blocks = _blocks(words, total, vocabulary_bytes, "word")
    for k, block in enumerate(blocks):
        got = block.select("lang", "word", "id").toArrow().combine_chunks()
        tables = {}
        for lang in pc.unique(got["lang"]).to_pylist():
            mine = got.filter(pc.equal(got["lang"], lang))
            tables[lang] = (mine["word"].combine_chunks().cast(pa.large_string()), mine["id"].to_numpy())
        shared, last = context.broadcast(tables), k == len(blocks) - 1
        none = (pa.array([], pa.large_string()), np.zeros(0, np.int64))

        def work(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for lang, data in slices(batches):
                found = list(_stretches(*_numbers(data, *shared.value.get(lang, none), None), longest))
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())],
                                                 names=["starts", "numbers"])

        def part(batches: Iterable[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            """A pass of several: rows are slices, which keep their text and the numbers so far until the last pass."""
            for b in batches:
                for i in range(b.num_rows):
                    lang, data = b.column(0)[i].as_py(), np.frombuffer(b.column(1)[i].as_buffer(), np.uint8)
                    old = b.column(2)[i]
                    number, ends = _numbers(data, *shared.value.get(lang, none), np.frombuffer(old.as_buffer(), np.int32) if old.is_valid else None)
                    if last:
                        found = list(_stretches(number, ends, longest))
                        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())],
                                                         names=["starts", "numbers"])
                    else:
                        yield pa.RecordBatch.from_arrays([b.column(0)[i:i + 1], b.column(1)[i:i + 1], pa.array([number.tobytes()], pa.binary())],
                                                         names=["lang", "data", "number"])

        if len(blocks) == 1:
            out = texts.mapInArrow(work, "starts long, numbers binary")
        else:
            if not k:
                texts = texts.mapInArrow(_sliced, "lang string, data binary, number binary")
            out = texts.mapInArrow(part, "starts long, numbers binary" if last else "lang string, data binary, number binary")
        texts = written(out, "phrase-texts")
        shared.destroy()
    return texts


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, data in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([data.tobytes()], pa.binary()), pa.array([None], pa.binary())],
                                         names=["lang", "data", "number"])


def candidates(numbers: np.ndarray, starts: int, size: int, known: trie.DoubleArray | None, whole: bool, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(candidates of ``size`` words that start at the first ``starts`` positions, counts): row of the first words * symbols + last word."""
    numbers = np.append(numbers, np.full(size, -1, np.int32)).astype(np.int64)
    n = len(numbers) - size
    at = np.flatnonzero(numbers[:n] >= 0)
    if known is None:
        accepted = numbers[:n + 1]
    else:
        state = np.zeros(len(at), np.int64)
        for j in range(size - 1):
            state = known.step(state, numbers[at + j])
            on = state >= 0
            at, state = at[on], state[on]
        accepted = np.full(n + 1, -1, np.int64)
        accepted[at] = known.accepts[state]
    at = at[(at < starts) & (accepted[at] >= 0) & (numbers[at + size - 1] >= 0)]
    if whole:
        at = at[accepted[at + 1] >= 0]
    return np.unique(accepted[at] * symbols + numbers[at + size - 1], return_counts=True)


def summed(parts: Iterable[tuple[np.ndarray, np.ndarray]], limit: int = HELD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts by key added up, so that a task sends a key once; whenever over ``limit`` different keys are held, they are sent."""
    keys, counts, held, merged = [], [], 0, 0
    for key, n in parts:
        keys.append(key)
        counts.append(n)
        held += len(key)
        if held >= max(limit, 2 * merged):
            key, n = _added(keys, counts)
            if len(key) >= limit:
                yield key, n
                key, n = key[:0], n[:0]
            keys, counts, held, merged = [key], [n], len(key), len(key)
    if held:
        yield _added(keys, counts)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def next_level(texts: DataFrame, shorter: DataFrame | None, size: int, symbols: int, least: int, trie_phrases: int) -> DataFrame:
    """(phrase, n) of the frequent phrases of ``size`` words; ``shorter`` has those of one word less (None: all words)."""
    levels, context = [], texts.sparkSession.sparkContext
    blocks = [None] if shorter is None else _blocks(shorter, shorter.count(), trie_phrases, "phrase")
    whole = len(blocks) == 1
    for block in blocks:
        phrases = None
        if block is not None:
            got = block.select("phrase").toArrow()["phrase"].combine_chunks()
            phrases = got.flatten().to_numpy().astype(np.int32).reshape(-1, size - 1)
            if not len(phrases):
                continue
        shared = context.broadcast((phrases if phrases is None else trie.build(phrases, symbols), phrases))

        def work(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value[0]
            rows = ((b, i) for b in batches for i in range(b.num_rows))
            parts = (candidates(np.frombuffer(b.column(1)[i].as_buffer(), np.int32), b.column(0)[i].as_py(), size, known, whole, symbols) for b, i in rows)
            for key, n in summed(parts):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

        def spelled(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            phrases = shared.value[1]
            for b in batches:
                head, last = np.divmod(b.column(0).to_numpy(), symbols)
                words = np.column_stack([head if phrases is None else phrases[head], last]).astype(np.int32)
                words = pa.FixedSizeListArray.from_arrays(words.ravel(), size).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([words, b.column(1)], names=["phrase", "n"])

        counts = texts.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        levels.append(written(counts.mapInArrow(spelled, "phrase array<int>, n long"), f"phrases-{size}"))
        shared.destroy()
    if not levels:
        return texts.sparkSession.createDataFrame([], "phrase array<int>, n long")
    out = levels[0]
    for more in levels[1:]:
        out = out.union(more)
    return out


def mine_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP, share: int = 100,
                 vocabulary_bytes: int = VOCABULARY_BYTES, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, words): each language's first ``top`` phrases (None: all) of ``docs`` (lang, text)."""
    texts = _of_texts(docs)
    words, totals = word_counts(texts, least)
    words = written(placed(words.orderBy(F.col("n").desc(), "lang", "word"), "id"), "phrase-vocabulary")
    symbols = max(1, words.count())
    texts = numbered_texts(texts, words, longest, vocabulary_bytes)
    levels = []
    for size in range(2, longest + 1):
        levels.append(next_level(texts, levels[-1] if levels else None, size, symbols, least, trie_phrases))
    counts = words.select(F.array(F.col("id").cast("int")).alias("phrase"), "n")
    longer = levels[0]
    for level in levels[1:]:
        longer = longer.union(level)
    counts = counts.union(longer)
    part = lambda x, n: F.slice("phrase", x, n)
    size = F.size("phrase")
    covered = longer.filter(size > 2).select(F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"), F.col("n").alias("more"))
    covered = covered.groupBy("phrase").agg(F.max("more").alias("more"))
    left = longer.withColumnRenamed("n", "a").join(covered, "phrase", "left").filter(
        F.col("more").isNull() | (F.col("more") * 100 < F.col("a") * share)).drop("more")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"x": part(1, F.col("k")), "y": part(F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.select(F.col("phrase").alias("x"), F.col("n").alias("l")), "x")
    cuts = cuts.join(counts.select(F.col("phrase").alias("y"), F.col("n").alias("r")), "y")
    # Words back from their numbers, and with them the language.
    named = left.select("phrase", F.posexplode("phrase").alias("i", "id")).join(words.select(F.col("id").cast("int").alias("id"), "lang", "word"), "id")
    named = named.groupBy("phrase").agg(F.first("lang").alias("lang"), F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]).alias("words"))
    of_lang = F.col("n").cast("decimal(38,0)")
    score = F.call_function("div", F.col("a") * of_lang * 1000, F.col("l").cast("decimal(38,0)") * F.col("r"))
    cuts = cuts.join(named, "phrase").join(totals, "lang").withColumn("score", score)
    best = cuts.groupBy("phrase", "lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    out = best.select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score", F.size("words").cast("long").alias("n_words"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = out.withColumn("rank", F.row_number().over(order).cast("long"))
    return out if top is None else out.filter(F.col("rank") <= top)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return mine_phrases(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS p FROM documents WHERE text IS NOT NULL),
word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
gram AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, range(1, 6) AS r(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, s, CAST(count(*) AS HUGEINT) AS n FROM gram GROUP BY lang, k, s HAVING count(*) >= 100),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM word GROUP BY lang),
cand AS (SELECT lang, k, s, n, string_split(s, ' ') AS w FROM f WHERE k > 1),
inner_of AS (
    SELECT lang, s, max(n) AS more FROM (
        SELECT lang, n, array_to_string(w[i:i + m - 1], ' ') AS s
        FROM (SELECT lang, n, w, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 5) AS r(m) WHERE m < k)) GROUP BY lang, s),
cut AS (
    SELECT c.lang, c.s, c.n AS a, j, x.n AS l, y.n AS r, t.n, 1000 * c.n * t.n // (x.n * y.n) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) AS c LEFT JOIN inner_of AS o ON c.lang = o.lang AND c.s = o.s
    JOIN f AS x ON x.lang = c.lang AND x.s = array_to_string(c.w[1:j], ' ')
    JOIN f AS y ON y.lang = c.lang AND y.s = array_to_string(c.w[j + 1:], ' ')
    JOIN total AS t ON t.lang = c.lang WHERE o.more IS NULL OR 100 * o.more < 100 * c.n),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, s ORDER BY score, j) AS b FROM cut),
line AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM best WHERE b = 1)
SELECT lang, rank, s AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM line WHERE rank <= 2000
"""
