"""Sharding by a keyed permutation of global row numbers (DataFrame functions only).

A row's number is its place in the table: files in order of their paths, rows in file order. A
Feistel network permutes ``0 .. n-1``; values it sends outside are walked along their cycle until
they are inside. ``shard = p % shards`` and ``slot = p // shards``: counts of any two shards differ
by one at most, slots have no gaps, and both follow from the row number alone. No row is shuffled,
so equal texts, a hot source or repeated ids cost nothing.

Defined results: null text counts as empty; rows with equal or null ids are different rows; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonix.session import scratch_path

ROUNDS = 6
#: The table of files is broadcast up to this many bytes of paths, and joined by shuffle beyond.
BROADCAST_BYTES = 64 << 20


def _row_place(df: DataFrame) -> tuple[Column, Column]:
    meta = df.metadataColumn("_metadata")
    return meta["file_path"], meta["row_index"]


def _files(df: DataFrame) -> list[tuple[str, int]] | None:
    """(path, rows) of the files that ``df`` reads whole; None if it is more than a scan of whole files."""
    try:
        path, index = _row_place(df)
        found = df.select(path.alias("p"), index.alias("i")).groupBy("p").agg(F.count("*"), F.max("i") + 1).collect()
    except AnalysisException:  # no file columns
        return None
    return sorted((p, n) for p, n, _ in found) if all(n == last for _, n, last in found) else None


def numbered(df: DataFrame, name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with its global row number, and the count of rows. Anything but a scan is first written to the shared folder."""
    files = _files(df)
    if files is None:
        out = scratch_path(df.sparkSession, "shard-input")
        df.write.parquet(out)
        df = df.sparkSession.read.parquet(out)
        files = _files(df) or []
    path, index = _row_place(df)
    first, total = [], 0
    for p, n in files:
        first.append((p, total))
        total += n
    before = df.sparkSession.createDataFrame(first or [("", 0)], "`__file` string, `__before` long")
    if sum(len(p) + 16 for p, _ in first) <= BROADCAST_BYTES:
        before = F.broadcast(before)
    out = df.withColumns({"__path": path, "__index": index})
    out = out.join(before, out["__path"] == before["__file"], "left")
    return out.withColumn(name, F.col("__before") + F.col("__index")).drop("__path", "__index", "__file", "__before"), total


def _sides(n: int) -> tuple[int, int]:
    """(a, bits of b): ``a * b`` holds ``n`` values and exceeds ``n`` by less than ``b``."""
    bits = 0
    while 4 ** bits < n:
        bits += 1
    return max(1, -(-n // 2 ** bits)), bits


def feistel(v: Column, n: int, seed: int) -> Column:
    """One pass of the network over ``0 .. a*b-1``, alternately adding a hash of one half to the other."""
    a, bits = _sides(n)
    b = 2 ** bits

    def turn(s, k):
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(seed), k, s["r"]), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(F.lit(seed), -k - 1, left), F.lit(b)), F.lit(b))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    begin = F.struct(F.shiftright(v, bits).alias("l"), F.pmod(v, F.lit(b)).cast("long").alias("r"))
    steps = F.array(*[F.lit(i) for i in range(ROUNDS // 2)])
    return F.aggregate(steps, begin, turn, lambda s: s["l"] * F.lit(b) + s["r"])


def walk_length(spark, n: int, seed: int) -> int:
    """Passes after which every cycle walk that starts inside ``0 .. n-1`` is inside again.

    Only values outside (fewer than the square root of ``n``) can prolong a walk, so they alone are followed.
    """
    a, bits = _sides(n)
    steps, out = 1, spark.range(n, a * 2 ** bits).select(F.col("id").alias("v"))
    while not out.isEmpty():
        out = out.select(feistel(F.col("v"), n, seed).alias("v")).filter(F.col("v") >= n)
        steps += 1
    return steps


def permuted(v: Column, n: int, seed: int, steps: int) -> Column:
    """The keyed permutation of ``0 .. n-1``: passes until inside, ``steps`` of them at most."""
    walk = F.array(*[F.lit(i) for i in range(steps)])
    return F.aggregate(walk, F.lit(n).cast("long"),
                       lambda s, i: F.when(i == 0, feistel(v, n, seed)).when(s < n, s).otherwise(feistel(s, n, seed)))


def shard_rows(df: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard) of every row."""
    rows, n = numbered(df, "__row")
    if not n:
        return rows.select(*df.columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    p = permuted(F.col("__row"), n, seed, walk_length(df.sparkSession, n, seed))
    rows = rows.withColumn("__place", p)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")]
    return rows.select(*kept, F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
                       ((F.col("__place") - F.pmod("__place", F.lit(shards))) / F.lit(shards)).cast("long").alias("slot"))


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return shard_rows(docs).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
