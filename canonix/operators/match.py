"""Deterministic column matching across datasets (W1, re-aimed).

The reference asks a language model to group columns that mean the same thing.
Here the same outcome (groups, canonical name, type) comes from a Spark job:

1. **Catalog** of columns (schema metadata, one row per column): a type family
   (Integer / Float / String, others by their type) and a name key (lower case, the dataset's common
   ``x_`` prefix removed, split into tokens).
2. **Name score**: token Jaccard or edit similarity between columns of different datasets. Candidates come
   from prefix-filtered joins: tokens and trigrams are put in a global order, rarest first, and a column
   is joined by as many of its first ones as any partner of that score must share, so ``id`` and ``name`` do
   not bring all columns together. Names that differ in a qualifier only (``north_yield``, ``south_yield``) mean different things.
3. **Value overlap** of text columns. A theta sketch a column (a bounded buffer, one pass a dataset) rules out pairs whose
   overlap is certainly too small; the columns of the others are compared exactly: every cell becomes
   ``(hash of the value, column bit)``; grouping by it ORs the bits into a mask of the columns holding it (combined per
   task, so a value repeated in a third of all rows is one row per task, and no text is shuffled), and
   masks are counted. Each mask row is then exploded once per member column
   and one grouped sum per column yields its whole row of shared counts, so no
   pair is ever emitted per value or per mask.
4. **Decision**: numbers need a name match (dense integer
   keys overlap by accident); other types too, and across types the names must be equal; text columns may also match on value
   containment, weighed by the number of shared values.
5. **Assignment**: between two datasets a column has one partner at most, the one that is best for both.
6. **Groups**: connected components of these pairs by iterated min-label propagation (lineage cut with
   ``checkpoint()``), each split so that no group holds two columns of a dataset or two qualifiers of a name: best pairs
   first, a pair that would bring such two together is left out.
7. **Canonical name**: the most frequent name key of the group (ties: lexical).
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import LONG_SCHEMA, quote

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class MatchConfig:
    name_threshold: float = 0.5
    containment_threshold: float = 0.8
    #: Entries of a column's sketch, as a power of two.
    sketch_bits: int = 12


def type_family(dt: T.DataType) -> str | None:
    if isinstance(dt, _INTEGRAL):
        return "Integer"
    if isinstance(dt, _FLOAT):
        return "Float"
    if isinstance(dt, (T.StringType, T.BooleanType)):
        return "String"
    return None


def _common_prefix(names: list[str]) -> str:
    """The ``x_`` prefix shared by every column of a dataset (``c_`` in c_name, c_custkey).

    One or two letters only: a longer one (``south_``) is a qualifier, which tells measures apart.
    """
    if len(names) < 2:
        return ""
    heads = {n.lower().split("_", 1)[0] + "_" if "_" in n else None for n in names}
    if len(heads) == 1 and None not in heads and len(min(heads)) <= 3:
        return heads.pop()
    return ""


def name_tokens(name: str, prefix: str = "") -> list[str]:
    low = name.lower().strip()
    if prefix and low.startswith(prefix) and len(low) > len(prefix):
        low = low[len(prefix):]
    return [t for t in re.split(r"[^0-9a-z]+", low) if t]


def column_catalog(spark: SparkSession, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: ``(col_id, dataset, column_name, position, family, data_type, name_key, tokens)``."""
    rows = []
    for ds in sorted(datasets):
        fields = datasets[ds].schema.fields
        prefix = _common_prefix([f.name for f in fields])
        for pos, f in enumerate(fields):
            toks = name_tokens(f.name, prefix)
            rows.append((f"{ds}\u0001{f.name}", ds, f.name, pos, type_family(f.dataType), f.dataType.simpleString(),
                         "_".join(toks) or f.name.lower(), toks))
    schema = ("col_id string, dataset string, column_name string, position int, family string, data_type string, "
              "name_key string, tokens array<string>")
    return spark.createDataFrame(rows, schema)


def _ranked(tokens: DataFrame) -> DataFrame:
    """``tokens`` (id, g) with ``place`` of each token among its column's, rarest of all columns first."""
    count = tokens.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("id").orderBy("n", "g")
    return tokens.join(count, "g").withColumn("place", F.row_number().over(order)).drop("n")


def name_candidates(base: DataFrame, threshold: float, edit_threshold: float) -> DataFrame:
    """Pairs of columns that may reach a score, from ``base`` (id, dataset, tokens, compact).

    Tokens: sets of n and m that share a fraction ``threshold`` of their union share ``o = ceil(t (n + m) / (1 + t))``, hence
    one of the first ``n - o + 1`` and ``m - o + 1`` by rarity; both sizes are part of the key. Trigrams: names of l
    letters within e edits lose 3e at most, hence share one of the first ``3e + 1``.
    """
    sets = base.select("id", "dataset", F.array_distinct("tokens").alias("t")).withColumn("n", F.size("t"))
    place = _ranked(sets.select("id", F.explode("t").alias("g")))
    sizes = sets.filter("n > 0").select("id", "dataset", "n", F.explode(F.sequence(
        F.ceil(F.col("n") * threshold).cast("int"), F.floor(F.col("n") / threshold).cast("int"))).alias("m"))
    need = F.ceil(F.round((F.col("n") + F.col("m")) * threshold / (1 + threshold), 9))
    keys = sizes.join(place, "id").filter(F.col("place") <= F.col("n") - need + 1)
    a, b = keys.alias("a"), keys.alias("b")
    by_token = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.n") == F.col("b.m")) & (F.col("a.m") == F.col("b.n"))
                      & (F.col("a.dataset") < F.col("b.dataset")))
    lost = 1 - edit_threshold
    texts = base.select("id", "dataset", "compact").withColumn(
        "e", F.floor(F.round(F.length("compact") / edit_threshold * lost, 9)).cast("int"))
    grams = texts.select("id", F.explode(F.expr(
        "array_distinct(transform(sequence(1, greatest(length(compact) - 2, 1)), i -> substring(compact, i, 3)))")).alias("g"))
    # Without room for an edit only equal names do.
    spelled = texts.filter("e = 0").select("id", "dataset", F.concat(F.lit("="), "compact").alias("g"))
    edits = texts.filter("e > 0").join(_ranked(grams), "id").filter(F.col("place") <= 3 * F.col("e") + 1).select("id", "dataset", "g")
    near = spelled.union(edits).union(texts.filter("e > 0").select("id", "dataset", F.concat(F.lit("="), "compact")))
    c, d = near.alias("a"), near.alias("b")
    by_gram = c.join(d, (F.col("a.g") == F.col("b.g")) & (F.col("a.dataset") < F.col("b.dataset")))
    pair = [F.col("a.id").alias("col_a"), F.col("b.id").alias("col_b")]
    return by_token.select(*pair).union(by_gram.select(*pair)).distinct()


#: How many tokens at the end two names have in common.
_TAIL = ("aggregate(sequence(1, greatest(least(size({a}), size({b})), 1)), 0, (n, i) -> "
         "if(n = i - 1 and try_element_at({a}, -i) = try_element_at({b}, -i), i, n))")


def qualified_apart(a: str, b: str) -> Column:
    """Whether two token lists end alike and begin with different qualifiers."""
    tail = _TAIL.format(a=a, b=b)
    head = "slice({x}, 1, size({x}) - {tail})"
    left, right = head.format(x=a, tail=tail), head.format(x=b, tail=tail)
    return F.expr(f"{tail} > 0 and size({left}) > 0 and size({right}) > 0 and not arrays_overlap({left}, {right})")


def name_pairs(catalog: DataFrame, edit_threshold: float = 0.85, threshold: float = 0.5) -> DataFrame:
    """Name scores for column pairs of different datasets.

    Score = the larger of the token
    Jaccard and the edit similarity ``1 - levenshtein / longer length`` when the
    latter reaches ``edit_threshold`` (``drug_id`` ~ ``drugid``, but not
    ``nationkey`` ~ ``regionkey``); pairs below ``threshold`` are left out, as are
    names that differ in their qualifiers only.
    """
    base = catalog.select(F.col("col_id").alias("id"), "dataset", "tokens",
                          F.regexp_replace("name_key", "_", "").alias("compact"))
    cand = name_candidates(base, threshold, edit_threshold)
    ba, bb = base.alias("ba"), base.alias("bb")
    scored = cand.join(ba, F.col("col_a") == F.col("ba.id")).join(bb, F.col("col_b") == F.col("bb.id")).select(
        "col_a", "col_b", F.col("ba.tokens").alias("ta"), F.col("bb.tokens").alias("tb"),
        F.col("ba.compact").alias("ca"), F.col("bb.compact").alias("cb"))
    ta, tb = F.array_distinct(F.col("ta")), F.array_distinct(F.col("tb"))
    inter = F.size(F.array_intersect(ta, tb))
    jacc = inter / (F.size(ta) + F.size(tb) - inter)
    longer = F.greatest(F.length("ca"), F.length("cb"))
    edit = 1 - F.levenshtein("ca", "cb") / longer
    score = F.greatest(jacc, F.when(edit >= edit_threshold, edit).otherwise(F.lit(0.0)))
    return scored.filter(~qualified_apart("ta", "tb")).select("col_a", "col_b", score.alias("name_score")).where(
        F.col("name_score") >= threshold)


_WORD = 62  # column bits per bigint word (keeps every mask positive)


def _basic_columns(catalog_rows: list) -> list:
    """Columns taking part in value overlap, in ``col_id`` order (their bit index)."""
    return sorted((r for r in catalog_rows if r["family"] is not None), key=lambda r: r["col_id"])


def value_rows(datasets: Mapping[str, DataFrame], catalog_rows: list) -> DataFrame:
    """``(h0, h1, w0..wk)`` per non-null cell: two hashes of its text, the cell's column as one bit of a bigint mask."""
    cols = _basic_columns(catalog_rows)
    words = max(1, -(-len(cols) // _WORD))
    parts = []
    by_ds: dict[str, list] = {}
    for idx, r in enumerate(cols):
        by_ds.setdefault(r["dataset"], []).append((idx, r))
    for ds, items in by_ds.items():
        entries = []
        for idx, r in items:
            ws = ", ".join(
                f"'w{j}', {('CAST(1 AS BIGINT) << ' + str(idx % _WORD)) if j == idx // _WORD else 'CAST(0 AS BIGINT)'}"
                for j in range(words))
            text = f"CAST({quote(r['column_name'])} AS STRING)"
            entries.append(f"named_struct('h0', IF({text} IS NULL, NULL, xxhash64({text})), 'h1', xxhash64(1, {text}), {ws})")
        parts.append(datasets[ds].selectExpr(f"inline(array({', '.join(entries)}))"))
    longv = reduce(lambda x, y: x.union(y), parts)
    return longv.where(F.col("h0").isNotNull())


def signature_masks(datasets: Mapping[str, DataFrame], catalog_rows: list) -> DataFrame:
    """``(w0..wk, cnt)``: how many distinct values exactly this set of columns (a bit mask) holds.

    Values are told apart by 128 bits of hash. Grouping by value ORs the column bits (``bit_or`` is combined per task
    before the shuffle, so a value repeated in a third of all rows is one row
    per task); counting per mask then leaves at most one row per distinct
    column set.
    """
    cols = _basic_columns(catalog_rows)
    words = max(1, -(-len(cols) // _WORD))
    wnames = [f"w{j}" for j in range(words)]
    by_value = value_rows(datasets, catalog_rows).groupBy("h0", "h1").agg(
        *[F.bit_or(w).alias(w) for w in wnames])
    return by_value.groupBy(*wnames).agg(F.count(F.lit(1)).alias("cnt"))


def value_overlap(datasets: Mapping[str, DataFrame], catalog: DataFrame) -> DataFrame:
    """Shared distinct values per column pair of different datasets and the same family.

    ``(col_a, col_b, shared, distinct_a, distinct_b, jaccard, containment)``.
    From the mask table: every mask row is exploded once per member column
    ``a`` (linear in the mask sizes), and one grouped sum per column turns the
    masks into the whole row of counts ``shared(a, b)`` at once (bit ``b`` of
    each mask times its count). No pair is emitted per value or per mask; the
    only pairs are the result itself, bounded by the number of columns squared.
    ``shared(a, a)`` is the distinct count of ``a``.
    """
    cat_rows = catalog.collect()  # schema metadata: one row per column
    from canonix.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(catalog.sparkSession)
    cols = _basic_columns(cat_rows)
    words = max(1, -(-len(cols) // _WORD))
    wnames = [f"w{j}" for j in range(words)]
    # The heavy pass runs once; its small result is written to the shared checkpoint folder.
    masks = signature_masks(datasets, cat_rows).checkpoint()
    members = " , ".join(
        f"transform(filter(sequence(0, {_WORD - 1}), i -> ((w{j} >> i) & 1) = 1), i -> i + {j * _WORD})"
        for j in range(words))
    per_member = masks.selectExpr(*wnames, "cnt", f"explode(concat({members})) AS a")
    row_of_counts = per_member.groupBy("a").agg(*[
        F.sum(F.col("cnt") * F.shiftright(F.col(f"w{b // _WORD}"), b % _WORD).bitwiseAND(F.lit(1))).alias(f"c{b}")
        for b in range(len(cols))
    ])
    counts = F.array(*[F.col(f"c{b}") for b in range(len(cols))])
    ids = F.array(*[F.lit(r["col_id"]) for r in cols])
    cells = row_of_counts.select(
        "a", F.element_at(counts, F.col("a") + 1).alias("distinct_a"),
        F.posexplode(counts).alias("b", "shared"))
    pairs = cells.where((F.col("b") > F.col("a")) & (F.col("shared") > 0))
    nd = cells.where(F.col("b") == F.col("a")).select(F.col("b").alias("bb"), F.col("shared").alias("distinct_b"))
    out = pairs.join(F.broadcast(nd), F.col("b") == F.col("bb")).select(  # one row per column
        F.element_at(ids, F.col("a") + 1).alias("col_a"), F.element_at(ids, F.col("b") + 1).alias("col_b"),
        "shared", "distinct_a", "distinct_b")
    meta = catalog.select("col_id", "dataset", "family")
    ma, mb = F.broadcast(meta).alias("ma"), F.broadcast(meta).alias("mb")
    out = (
        out.join(ma, F.col("col_a") == F.col("ma.col_id"))
        .join(mb, F.col("col_b") == F.col("mb.col_id"))
        .where((F.col("ma.dataset") != F.col("mb.dataset")) & (F.col("ma.family") == F.col("mb.family")))
        .select("col_a", "col_b", "shared", "distinct_a", "distinct_b")
    )
    return out.withColumns({
        "jaccard": F.col("shared") / (F.col("distinct_a") + F.col("distinct_b") - F.col("shared")),
        "containment": F.col("shared") / F.least("distinct_a", "distinct_b"),
    })


def sketch_pairs(datasets: Mapping[str, DataFrame], catalog: DataFrame, cfg: MatchConfig) -> list[tuple[str, str]]:
    """Pairs of text columns whose containment may reach the threshold, by theta sketches (schema-sized).

    A sketch keeps the smallest hashes of a column, ``2 ** sketch_bits`` at most. A pair goes only if its estimated intersection is below
    the threshold by more than five standard deviations and ten missed hashes.
    """
    text = [r for r in catalog.where("family = 'String'").collect()]
    by_ds: dict[str, list] = {}
    for r in text:
        by_ds.setdefault(r["dataset"], []).append(r)
    rows = []
    for ds, cols in sorted(by_ds.items()):
        one = datasets[ds].agg(*[F.theta_sketch_agg(F.col(quote(r["column_name"])).cast("string"), cfg.sketch_bits).alias(f"s{i}")
                                 for i, r in enumerate(cols)])
        rows.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(r["col_id"]).alias("id"), F.lit(ds).alias("dataset"), F.col(f"s{i}").alias("s")) for i, r in enumerate(cols)]))))
    if len(rows) < 2:
        return []
    sketches = reduce(lambda x, y: x.union(y), rows).withColumn("n", F.theta_sketch_estimate("s")).checkpoint()
    a, b = sketches.alias("a"), sketches.alias("b")
    # The pairs are of columns, as the result may be; each costs two bounded sketches.
    pairs = a.join(b, F.col("a.dataset") < F.col("b.dataset")).withColumn(
        "shared", F.theta_sketch_estimate(F.theta_intersection("a.s", "b.s")))
    share = F.least(F.lit(1.0), F.lit(float(1 << cfg.sketch_bits)) / F.greatest("a.n", "b.n", F.lit(1)))
    most = F.col("shared") + 5 * F.sqrt(F.col("shared") / share) + F.when(share < 1, 10 / share).otherwise(0.5)
    may = (F.least("a.n", "b.n") > 0) & (most >= cfg.containment_threshold * F.least("a.n", "b.n"))
    return [(r[0], r[1]) for r in pairs.filter(may).select("a.id", "b.id").collect()]


def score_pairs(datasets: Mapping[str, DataFrame], catalog: DataFrame, cfg: MatchConfig | None = None) -> DataFrame:
    """All candidate pairs with name and overlap evidence, ``score`` and the accept decision."""
    from canonix.session import ensure_checkpoint_dir

    cfg = cfg or MatchConfig()
    ensure_checkpoint_dir(catalog.sparkSession)
    names = name_pairs(catalog, threshold=cfg.name_threshold)
    likely = sketch_pairs(datasets, catalog, cfg)
    some = {c for pair in likely for c in pair}
    if some:
        chosen = catalog.filter(F.col("col_id").isin(sorted(some)))
        over = value_overlap(datasets, chosen).select("col_a", "col_b", "shared", "jaccard", "containment")
        over = over.filter(F.col("containment") >= cfg.containment_threshold)
        both = names.join(over, ["col_a", "col_b"], "full")
    else:
        both = names.withColumns({"shared": F.lit(0).cast("long"), "jaccard": F.lit(0.0), "containment": F.lit(0.0)})
    kind = F.coalesce("family", "data_type")
    for side in ("a", "b"):
        both = both.join(catalog.select(F.col("col_id").alias(f"col_{side}"), F.col("dataset").alias(f"dataset_{side}"),
                                        kind.alias(f"family_{side}")), f"col_{side}")
    both = both.fillna({"name_score": 0.0, "shared": 0, "jaccard": 0.0, "containment": 0.0})
    number = F.col("family_a").isin("Integer", "Float") & F.col("family_b").isin("Integer", "Float")
    by_name = F.when((F.col("family_a") == F.col("family_b")) | number | (F.col("name_score") == 1), F.col("name_score")).otherwise(0.0)
    # One shared value is weak evidence, many are strong.
    by_value = F.col("containment") * (1 - 1 / (1 + F.col("shared")))
    return both.withColumn("score", F.greatest(by_name, by_value)).withColumn(
        "accepted", F.col("score") >= F.least(F.lit(cfg.name_threshold), F.lit(cfg.containment_threshold / 2)))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """Of accepted pairs those that are best for both columns among the partners in the other's dataset (one to one)."""
    def rank(mine, other):
        order = Window.partitionBy(f"col_{mine}", f"dataset_{other}").orderBy(F.col("score").desc(), F.col("jaccard").desc(), f"col_{other}")
        return F.row_number().over(order)

    return pairs.withColumns({"ra": rank("a", "b"), "rb": rank("b", "a")}).filter("ra = 1 AND rb = 1").drop("ra", "rb")


def _apart(a: list[str], b: list[str]) -> bool:
    """:func:`qualified_apart` of two token lists."""
    n = 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    left, right = set(a[:len(a) - n]), set(b[:len(b) - n])
    return bool(n and left and right and not left & right)


def _split_group(edges):
    """Groups of one component (pandas): best pairs first, none that brings two columns of a dataset or two qualifiers together."""
    import pandas as pd

    group, info, linked = {}, {}, set()
    for e in edges.itertuples():
        for side in ("a", "b"):
            c = getattr(e, f"col_{side}")
            group.setdefault(c, [c])
            info[c] = getattr(e, f"dataset_{side}"), list(getattr(e, f"tokens_{side}"))
        linked.add((e.col_a, e.col_b))

    def clash(a, b):
        return info[a][0] == info[b][0] or ((a, b) not in linked and (b, a) not in linked and _apart(info[a][1], info[b][1]))

    for e in edges.sort_values(["score", "col_a", "col_b"], ascending=[False, True, True]).itertuples():
        left, right = group[e.col_a], group[e.col_b]
        if left is right or any(clash(a, b) for a in left for b in right):
            continue
        left += right
        for c in right:
            group[c] = left
    return pd.DataFrame([(c, min(members)) for c, members in group.items()], columns=["id", "component"])


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, component)`` with component = the smallest id reachable.

    Vertices get dense integer ranks (in id order); labels are ranks. Each
    round propagates the minimum label over both edge directions and then
    jumps once (a vertex takes its label's label), so rounds grow with the log
    of the path length. Labels only decrease, so the first round that leaves
    their sum unchanged is the fixpoint (an exact test, no join with the
    previous round). Each round is checkpointed to the shared folder, keeping
    the lineage one round deep. Used on the column graph, whose size follows
    the number of columns, not rows.
    """
    from canonix.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(vertices.sparkSession)  # the cluster's shared folder (set locally only if absent)
    ranked = vertices.select("id").distinct().withColumn(
        "vid", F.row_number().over(Window.orderBy("id")).cast("bigint")).checkpoint()
    rid = ranked.select(F.col("id").alias("src"), F.col("vid").alias("s"))
    did = ranked.select(F.col("id").alias("dst"), F.col("vid").alias("d"))
    e = edges.join(rid, "src").join(did, "dst").select("s", "d")
    und = e.union(e.select(F.col("d").alias("s"), F.col("s").alias("d")))
    labels = ranked.select("vid", F.col("vid").alias("label"))
    prev = labels.agg(F.sum("label")).collect()[0][0]
    while True:  # labels only fall, so this ends
        nbr = und.join(labels.withColumnRenamed("vid", "s"), "s").groupBy(F.col("d").alias("vid")).agg(
            F.min("label").alias("nl"))
        step = labels.join(nbr, "vid", "left").select(
            "vid", F.least("label", F.coalesce("nl", "label")).alias("label"))
        jump = step.alias("v").join(step.alias("p"), F.col("v.label") == F.col("p.vid"), "left").select(
            F.col("v.vid").alias("vid"),
            F.least(F.col("v.label"), F.coalesce(F.col("p.label"), F.col("v.label"))).alias("label"))
        labels = jump.checkpoint()
        total = labels.agg(F.sum("label")).collect()[0][0]  # one number
        if total == prev:
            names = ranked.select(F.col("vid").alias("label"), F.col("id").alias("component"))
            return labels.join(ranked, "vid").join(names, "label").select("id", "component")
        prev = total


def match_columns(datasets: Mapping[str, DataFrame], cfg: MatchConfig | None = None) -> DataFrame:
    """Group columns into canonical features; returns the long map (S6 shape)."""
    cfg = cfg or MatchConfig()
    spark = next(iter(datasets.values())).sparkSession
    catalog = column_catalog(spark, datasets)
    # Accepted edges are computed once (one pass over the data) and written to the
    # checkpoint folder, so the component rounds below never re-run the scans.
    from canonix.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    pairs = best_pairs(score_pairs(datasets, catalog, cfg).where("accepted")).checkpoint()
    comps = connected_components(catalog.select(F.col("col_id").alias("id")),
                                 pairs.select(F.col("col_a").alias("src"), F.col("col_b").alias("dst")))
    edges = pairs.join(comps.withColumnRenamed("id", "col_a"), "col_a")
    for side in ("a", "b"):
        edges = edges.join(catalog.select(F.col("col_id").alias(f"col_{side}"), F.col("tokens").alias(f"tokens_{side}")), f"col_{side}")
    split = edges.groupBy("component").applyInPandas(_split_group, "id string, component string").checkpoint()
    members = catalog.join(split.withColumnRenamed("id", "col_id"), "col_id", "left").withColumn(
        "component", F.coalesce("component", "col_id"))
    names = members.groupBy("component", "name_key").agg(F.count(F.lit(1)).alias("n"))
    best = names.groupBy("component").agg(
        F.min_by("name_key", F.struct((-F.col("n")).alias("neg"), F.col("name_key"))).alias("canonical_name"))
    # Of the vocabulary Integer, Float, String: the narrowest that holds all members.
    fams = members.groupBy("component").agg(
        F.when(F.every(F.col("family").eqNullSafe("Integer")), "Integer")
        .when(F.every(F.coalesce(F.col("family").isin("Integer", "Float"), F.lit(False))), "Float").otherwise("String").alias("group_family"))
    groups = best.join(fams, "component")
    # unique canonical names: later groups with an equal name get a numeric suffix
    w = Window.partitionBy("canonical_name").orderBy("component")
    groups = groups.withColumn("k", F.row_number().over(w)).withColumn(
        "canonical_name", F.when(F.col("k") == 1, F.col("canonical_name"))
        .otherwise(F.concat_ws("_", "canonical_name", F.col("k").cast("string"))))
    groups = groups.withColumn("feature_pos", F.row_number().over(Window.orderBy("canonical_name")) - 1)
    m = members.join(groups.select("component", "canonical_name", "group_family", "feature_pos"), "component")
    wc = Window.partitionBy("component", "dataset").orderBy("position")
    m = m.withColumn("cand_pos", F.row_number().over(wc) - 1)
    out = m.select(
        F.col("feature_pos").cast("int"), "canonical_name", F.lit(None).cast("string").alias("semantic_meaning"),
        F.coalesce(F.col("group_family"), F.lit("String")).alias("data_type"), "dataset",
        F.col("cand_pos").cast("int"), "column_name", F.col("data_type").alias("column_type"),
        F.lit(None).cast("bigint").alias("nan_count"),
    )
    return out.select(*[f.name for f in LONG_SCHEMA.fields])
