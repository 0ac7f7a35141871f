r"""Line dedup by MinHash. Shingles are hashed in Arrow UDFs, all else is DataFrame functions.

The signatures as array functions, without Python, are whole as well but took 1097 CPU seconds a GB where
400 are allowed, as higher-order functions run uncompiled for every character; hence the freer style here.

Lines are what ``\n`` separates; blank ones stay where they are and take no part. A line is the set of
its 8-character shingles (a shorter line is one shingle). The signature is the least value of its hashed
shingles under each of 36 functions: two lines agree in a value with the probability of their Jaccard
similarity, and in each by itself, however short they are. Bands of four values give candidates (0.991
of pairs at 0.8, more above); the exact similarity of the shingle sets decides; lines of 0.8 or more are joined by
distributed union-find, and of each component only the first line of the corpus stays.

Equal lines are one line from the start. Within a band's bucket each line first meets the first one and its
three neighbours in the order of another band. Lines that are joined by then need no more comparison; a
bucket that still holds several classes is compared whole, in pairs of blocks of lines, so no candidate
is left out. Every bucket of more than twice ``PIECE`` lines, by exact counts, is cut into pieces of about
``PIECE`` lines by a hash, each piece with neighbours of its own, so no task sorts a large bucket; what is
compared whole is the bucket all the same. Defined results: the corpus is in table order (files by path, rows within);
null text stays null; a text all of whose lines go is empty; repeated rows keep their lines only once; texts are read
whole, whatever their number of lines; columns of the result's names (``__n_lines``, ``__n_gone``) give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canonix.llm.components import _written, components
from canonix.llm.shard import numbered
from canonix.llm.shingles import BANDS, are_similar, band_keys, similar_in_blocks
from canonix.session import scratch_path

THRESHOLD = 0.8
NEIGHBOURS = 3
#: Lines of a bucket that are compared at a time, with each other or with as many others.
BLOCK = 128
#: Lines of a piece of a large bucket, and how many keys of large buckets ``hot_keys`` shows at most.
PIECE, HOT_KEYS = 512, 1000
#: Ids of candidates and lists of dropped lines are broadcast up to this size, and joined by shuffle beyond.
BROADCAST_BYTES = 64 << 20
_RESULT = ("__n_lines", "__n_gone")
_INNER = ("__row", "__at", "__gone", "__path", "__index", "__file", "__before", *_RESULT)


def _lines(docs: DataFrame) -> DataFrame:
    """(row, pos, line) of the lines that are not blank."""
    each = docs.select(F.col("__row").alias("row"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return each.filter(F.col("line").rlike(r"[^ \t\r\x0b\x0c]"))


def place_bits(rows: int, longest: int, lines) -> int:
    """Bits that hold any line number of texts of ``longest`` bytes at most, beside those of ``rows`` row numbers.

    ``lines`` tells the most lines of a text, where their bytes alone leave too little room.
    """
    bits = max(1, longest.bit_length())
    if bits + rows.bit_length() > 63:
        bits = max(1, lines().bit_length())
    if bits + rows.bit_length() > 63:
        raise ValueError(f"{rows} rows with texts of up to {1 << bits} lines are more places than 63 bits hold")
    return bits


def _place(bits: int) -> Column:
    """A line's place in the corpus: row number, then line number."""
    return F.shiftleft(F.col("row").cast("long"), bits).bitwiseOR(F.col("pos").cast("long"))


def _line_id() -> list[Column]:
    """128 bits that name a line: two hashes of different seeds."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, to be broadcast if its measured size allows."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _buckets(texts: DataFrame) -> DataFrame:
    """(key, n, first): size and first line of each bucket of two lines or more, combined within tasks before the exchange."""
    each = texts.select("node", F.explode("keys").alias("key"))
    return each.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).filter("n > 1")


def hot_keys(texts: DataFrame, piece: int = PIECE) -> list[int]:
    """For a look at the data: band keys of more than ``2 * piece`` lines, the ``HOT_KEYS`` largest ones."""
    top = _buckets(texts).filter(F.col("n") > 2 * piece).orderBy(F.desc("n"), "key").limit(HOT_KEYS)
    return sorted(r["key"] for r in top.collect())


def _labels(texts: DataFrame) -> DataFrame:
    """(node, key, order): each band's key, with half of the next band's for the order within a bucket."""
    turned = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.shiftrightunsigned(F.get("keys", (i + 1) % BANDS), 32).alias("order")))
    return texts.select("node", F.explode(turned).alias("k")).select("node", "k.key", "k.order")


def _members(texts: DataFrame, piece: int) -> DataFrame:
    """(node, key, piece): the lines in buckets of two or more, with the bucket's ``first`` line and size ``n``, and up to three lines ``before`` each in its piece."""
    buckets = _written(_buckets(texts), "line-keys")  # most lines are alone in most buckets: those rows end here
    pieces = F.when(F.col("n") > 2 * piece, F.ceil(F.col("n") / piece)).otherwise(1)
    buckets = buckets.withColumn("pieces", pieces.cast("long"))
    large = _small(buckets.filter("pieces > 1").select("key", "pieces"), 16)
    labels = _labels(texts).join(large, "key", "left")
    labels = labels.withColumn("piece", F.coalesce(F.pmod(F.xxhash64("node"), "pieces"), F.lit(0).cast("long"))).drop("pieces")
    # Joined by piece, so that a join by shuffle brings no large bucket into one task.
    buckets = buckets.select("key", "n", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    near = Window.partitionBy("key", "piece").orderBy("order", "node")
    return labels.join(_small(buckets, 32), ["key", "piece"]).select("node", "key", "piece", "first", "n", *_before(near))


def _before(near: Window) -> list[Column]:
    return [F.lag("node", k).over(near).alias(f"before{k}") for k in range(1, NEIGHBOURS + 1)]


def similar_classes(texts: DataFrame, threshold: float = THRESHOLD, piece: int = PIECE) -> DataFrame:
    """(node, root): classes of the lines of ``texts`` (node, line, keys) that have a similar line."""
    members = _members(texts, piece)
    members = _written(members, "line-buckets")
    pairs = members.select("node", F.explode(F.array("first", *[f"before{k}" for k in range(1, NEIGHBOURS + 1)])).alias("other"))
    pairs = pairs.filter("other IS NOT NULL AND other != node").select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    pairs = _written(pairs, "line-pairs")
    lines = texts.select("node", "line").join(_small(_written(members.select("node").distinct(), "line-ids"), 8), "node")
    lines = _written(lines, "line-texts")
    both = pairs.join(lines.select(F.col("node").alias("a"), F.col("line").alias("x")), "a")
    both = both.join(lines.select(F.col("node").alias("b"), F.col("line").alias("y")), "b")
    found = both.select("a", "b", are_similar(threshold)("x", "y").alias("same")).filter("same").select("a", "b")
    roots = _written(components(_written(found, "similar-lines")), "line-classes")
    # Only pairs of a bucket of more lines than met here, of which some are in different classes, are left.
    rest = _rest(members.filter(F.col("n") > NEIGHBOURS + 1), roots, lines, threshold)
    joined = _small(_written(components(rest), "joined-classes"), 16)
    again = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
    return again.select("node", F.coalesce("next", "root").alias("root")).unionByName(joined).distinct()


def _rest(members: DataFrame, roots: DataFrame, lines: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(a, b): classes with similar lines in a bucket of ``members``; a line without a class is its own.

    A piece of a bucket is cut, by class, into blocks of ``block`` lines; a pair of blocks of the bucket is one piece of work. Blocks of one
    and the same class need no comparison, so a bucket of thousands of near copies and some others is cheap.
    """
    piece = F.col("piece") if "piece" in members.columns else F.lit(0).cast("long")
    rows = members.select("node", "key", piece.alias("piece")).join(_small(roots, 16), "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.floor((F.row_number().over(Window.partitionBy("key", "piece").orderBy("root", "node")) - 1) / block)
    rows = _written(rows.select("node", "key", "root", (F.shiftleft("piece", 32) + place).alias("block")), "line-blocks")
    blocks = rows.groupBy("key", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    meet = blocks.select("key", F.col("block").alias("i"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i")).join(
        blocks.select("key", F.col("block").alias("j"), "lo", "hi"), "key").filter("i <= j")
    meet = meet.filter("least(lo, lo_i) != greatest(hi, hi_i)")
    meet = meet.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    work = rows.join(meet, ["key", "block"]).join(lines, "node")
    work = work.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return work.select("key", "i", "j", "block", "node", "root", "line").mapInArrow(similar_in_blocks(threshold), "a long, b long")


def dropped_lines(docs: DataFrame, rows: int, threshold: float = THRESHOLD) -> DataFrame:
    """(row, gone): numbers of the lines that go, of numbered ``docs`` (``__row``), ``rows`` in all."""
    each = _lines(docs)
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0
    bits = place_bits(rows, longest, lambda: docs.agg(F.max(F.size(F.split("text", "\n")))).first()[0])
    texts = each.select("line", _place(bits).alias("place")).groupBy("line").agg(F.min("place").alias("node"), F.count("*").alias("n"))
    texts = texts.select("node", "n", "line", band_keys()("line").alias("keys"))
    out = scratch_path(docs.sparkSession, "lines")
    texts.write.option("compression", "zstd").parquet(out)
    texts = docs.sparkSession.read.parquet(out)
    roots = _small(_written(similar_classes(texts, threshold), "line-roots"), 16)
    kept = texts.join(roots, "node", "left").select(*_line_id(), "n", "node", F.coalesce("root", "node").alias("root"))
    kept = kept.filter("n > 1 OR root != node").select("h1", "h2", "root")
    found = each.select("row", "pos", *_line_id(), _place(bits).alias("place")).join(kept, ["h1", "h2"]).filter("place != root")
    return found.groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("gone"))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with texts without repeated lines, and ``__n_lines`` and ``__n_gone``."""
    own = [c for c in docs.columns if c in _INNER]
    if own:  # documents' columns of our names go by others meanwhile
        named = {c: f"__own{i}" for i, c in enumerate(own)}
        out = dedup_lines(docs.withColumnsRenamed(named), threshold)
        return out.select(*[F.col(named.get(c, f"`{c}`")).alias(c) for c in docs.columns if c not in _RESULT], *_RESULT)
    rows, n = numbered(docs, "__row")
    gone = _written(dropped_lines(rows, n, threshold), "dropped-lines")
    size = gone.agg(F.sum(F.size("gone") * 4 + 32)).first()[0] or 0
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES // 4 else gone
    gone = gone.withColumnsRenamed({"row": "__at", "gone": "__gone"})  # names that documents do not have
    joined = rows.join(gone, rows["__row"] == gone["__at"], "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    # Lines are cut once, and those that stay are taken by number.
    text = F.transform(F.array(lines), lambda l: F.array_join(F.transform(stay, lambda i: F.get(l, i)), "\n"))[0]
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(text)
    kept = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    return joined.select(*kept, n_lines.cast("long").alias("__n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__n_gone"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without near copies of earlier lines; ``n_chars`` follows."""
    out = dedup_lines(docs)
    return out.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after line dedup and its numbers of lines before and gone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).withColumnsRenamed({"__n_lines": "n_lines", "__n_gone": "n_gone"})
