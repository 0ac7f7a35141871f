r"""Mixing of sources to target weights by systematic sampling.

Sources, by code point and null last, weigh 5, 2, 1 and so on in turn and share all words by weight. A target
stops at ``cap`` times its source's size; the excess goes to the others by weight until none is above.
Every document of a source is expected ``target / source size`` times. A source's documents are put in
order of their size, then of a hash; the prefix sum of expected copies plus one random offset crosses an
integer once for each copy that is emitted. As sizes only rise along the prefix sum, a source's taken words
stay within about its largest document of the target, whatever the offset.

All documents of a source expect the same number of copies, so a prefix sum is the document's place in its
source times that number, exact in whole numbers (numerators over one denominator). Places come from the
written, sorted table (``places.py``); a third of all rows in one source is spread over tasks like any others.
The shares are settled by rounds over the table of sources; a round brings two sums to the driver.

Defined results: size is the number of ``[^\x20\x09-\x0D]+``; null and empty texts have size 0 and are
emitted at their source's rate; null sources are one source; null ids read as empty in the hash. Rows that agree in id and
text are interchangeable: repeated ones have places of their own. Texts are counted whole, however long. A source without words has
target 0 and no copies; an empty table gives no rows. Input columns named like a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.llm.places import placed, rows_before, with_files, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 2024
_WORD = r"[^\x20\x09-\x0D]+"
_RESULT = ("size", "source_size", "target", "copies")


def _whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _above(cap: int, left: int, weights: int) -> Column:
    """Whether a source's share of ``left`` by weight exceeds its cap."""
    return _whole("weight") * _whole(F.lit(left)) > _whole("source_size") * _whole(F.lit(cap * weights))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, share, shares): ``sizes`` (source, source_size) with targets.

    A document of the source is expected ``share / shares`` times.
    """
    ordered = placed(sizes.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(w) for w in weights])
    rows = written(ordered.select("source", "source_size",
                                  F.element_at(turn, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")).alias("weight")), "mix-sources")
    total, of_all = (x or 0 for x in rows.agg(F.sum("source_size"), F.sum("weight")).first())
    left, rest = total, of_all
    while rest:
        over = _above(cap, left, rest)
        capped, free = (int(x or 0) for x in rows.agg(F.sum(F.when(over, F.col("source_size") * cap)), F.sum(F.when(~over, F.col("weight")))).first())
        if (total - capped, free) == (left, rest):
            break
        left, rest = total - capped, free
    over = _above(cap, left, rest) if rest else F.lit(True)
    target = F.when(over, (F.col("source_size") * cap).cast("double")).otherwise(
        (_whole("weight") * _whole(F.lit(left))).cast("double") / F.lit(float(rest or 1)))
    return rows.select("source", "source_size", target.alias("target"),
                       F.when(over, _whole(F.lit(cap))).otherwise(_whole("weight") * _whole(F.lit(left))).alias("share"),
                       F.when(over, _whole(F.lit(1))).otherwise(_whole("source_size") * _whole(F.lit(rest))).alias("shares"))


def _hashed(text: Column, algorithm) -> Column:
    return algorithm(F.encode(text, "UTF-8"))


def mix_copies(docs: DataFrame, keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
               seed: int = SEED) -> DataFrame:
    """Columns ``keep`` (default: all) of every row of ``docs`` (doc_id, text, source), with ``size``, ``source_size``,
    ``target`` of its source and ``copies``, how often the mix takes it."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in _RESULT]
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    # Texts are read once, here.
    rows = with_files(written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("source").alias("source"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"), _hashed(key, F.md5).alias("tie")), "mix-sizes"))
    # Repeated rows part by their place in the files, so that they do not meet in one task.
    rows = rows.orderBy(F.col("source").asc_nulls_last(), "size", "tie", "__index", "__file").select("row", "source", "size")
    rows = with_files(written(rows, "mix-sorted"))
    spans = written(rows.groupBy("source", "__file").agg(
        F.count("*").alias("n"), F.sum("size").alias("words"), F.min("__index").alias("first")), "mix-spans")
    targets = source_targets(spans.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    named = F.coalesce(F.concat(F.lit(f"{seed}:"), F.col("source")), F.lit(f"{seed}"))
    random = F.conv(F.substring(_hashed(named, lambda x: F.sha2(x, 256)), 1, 15), 16, 10)  # below 2 ** 60
    targets = targets.withColumn("offset", _div(_whole(random) * F.col("shares"), _whole(F.lit(1 << 60))))
    # A span is the rows of one source in one file: this join's key holds a file's rows at most.
    spans = spans.withColumn("before", rows_before(within=["source"])).drop("n", "words")
    spans = written(spans.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
                    .select("a.*", *[f"b.{c}" for c in ("source_size", "target", "share", "shares", "offset")]), "mix-spans")
    rows = rows.alias("r").join(spans.alias("s"), (F.col("r.__file") == F.col("s.__file"))
                                & F.col("r.source").eqNullSafe(F.col("s.source")))
    place = F.col("before") + F.col("r.__index") - F.col("first")
    crossed = _crossed(place + 1) - _crossed(place)
    return rows.select(*[F.col("r.row").getField(c).alias(c) for c in keep], "size", "source_size", "target",
                       F.when(F.col("source_size") > 0, crossed).otherwise(F.lit(0)).cast("long").alias("copies"))


def _div(a: Column, b: Column) -> Column:
    """Whole quotient, exact."""
    return F.call_function("div", a, b)


def _crossed(place: Column) -> Column:
    """Integers crossed by the prefix sum up to ``place``."""
    return _div(_whole(place) * F.col("share") + _whole("offset"), F.greatest(F.col("shares"), _whole(F.lit(1))))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix: every document once for each copy, columns as they are, with ``copy`` (from 1)."""
    names = [c for c in docs.columns if c not in (*_RESULT, "copy")]
    taken = mix_copies(docs, **options).filter("copies > 0")
    return taken.select(*[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's target and the words that the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix_copies(docs, keep=["doc_id", "source"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


OP11_SQL = r"""
WITH doc AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('2024:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS tie FROM documents),
src AS (
    SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
    FROM (SELECT source, CAST(sum(size) AS HUGEINT) AS s FROM doc GROUP BY source)),
-- Sources in the order in which they reach their caps; the first j - 1 are capped.
line AS (
    SELECT *, row_number() OVER o AS j, coalesce(sum(3 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(s) OVER () AS total
    FROM src WINDOW o AS (ORDER BY 30 * s // w, source NULLS LAST)),
free AS (
    SELECT total - capped AS "left", rest FROM line WHERE w * (total - capped) <= 3 * s * rest ORDER BY j LIMIT 1),
share AS (
    SELECT source, s, CASE WHEN "left" IS NULL OR w * "left" > 3 * s * rest THEN CAST(3 * s AS DOUBLE)
            ELSE CAST(w * "left" AS DOUBLE) / CAST(rest AS DOUBLE) END AS target,
        CASE WHEN "left" IS NULL OR w * "left" > 3 * s * rest THEN CAST(3 AS HUGEINT) ELSE CAST(w * "left" AS HUGEINT) END AS a,
        CASE WHEN "left" IS NULL OR w * "left" > 3 * s * rest THEN CAST(1 AS HUGEINT) ELSE CAST(greatest(s, 1) * rest AS HUGEINT) END AS b,
        CAST(CAST('0x' || substr(sha256(coalesce('2024:' || source, '2024')), 1, 15) AS BIGINT) AS HUGEINT) AS h
    FROM src LEFT JOIN free ON true),
place AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, tie) - 1 AS k FROM doc)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST(c * size AS BIGINT) AS taken, place.source, CAST(c AS BIGINT) AS copies
FROM place JOIN share ON place.source IS NOT DISTINCT FROM share.source,
    LATERAL (SELECT CASE WHEN s = 0 THEN 0 ELSE ((k + 1) * a + h * b // 1152921504606846976) // b - (k * a + h * b // 1152921504606846976) // b END AS c) AS x
"""
