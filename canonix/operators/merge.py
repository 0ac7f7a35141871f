"""N-way full outer merge of standardized datasets on one canonical key (M1).

Semantics (reference-compatible, see README):

* every participating dataset is standardized first; the first dataset keeps
  canonical names, every later one has its non-key columns renamed with the
  suffix ``_from_<dataset with . -> _>`` (so ``1 + n*(k-1)`` columns);
* the key is coalesced (one key column), duplicate keys multiply, null keys
  never match and each null-key row appears once, unmatched;
* a dataset that maps no column to the key is skipped unless
  ``include_unkeyed=True`` (its rows are then appended unmatched).

Two physical strategies produce the same rows:

``spine`` (default)
    ``distinct(union(keys))`` then one ``LEFT JOIN`` per dataset. The spine is
    shuffled once, and a filter on the key reaches every scan. Keys holding too
    many rows (or exploding into too many output rows) are found with one
    pre-aggregated pass over the key columns and joined on a separate branch
    with a per-key 2-D salt: the accumulated rows are split into ``sa`` groups
    and the dataset's rows into ``sb`` groups, each side replicated across the
    other's groups, so each (key, sa, sb) cell is one bounded task. The branch
    takes the datasets with fewer rows first: only its last join has the rows of
    the output, and they are never exchanged.
``chain``
    the reference's left fold of ``FULL OUTER JOIN ... USING (key)``.
``layout``
    the spine over copies, for inputs that are costly to scan (CSV): each input is
    scanned once and its standardized rows are written as Parquet. Counts, null rows and hot rows read
    that copy; all other rows are written as a table bucketed and sorted by the key, so
    that the spine's joins exchange nothing but the spine's keys.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import HarmonizationMap, quote
from canonix.operators.standardize import feature_types, find_column, standardize, suffix_for
from canonix.session import scratch_path

_KEY_TMP = "__k"
#: A dataset's rows in one cell of a hot key, about: a task holds the matches of one accumulated row at a time.
CELL_ROWS = 512
#: Rows out and rows in that make a task of the hot branch, and the most tasks of one join.
TASK_OUTPUT, TASK_INPUT, MAX_TASKS = 1_000_000, 100_000, 10_000


class MergeTooLarge(RuntimeError):
    """The merged output would exceed the caller's row limit."""


@dataclass
class SkewConfig:
    """Thresholds for the hot-key branch of the spine merge.

    ``input_rows``: a key with more rows than this in any dataset is hot.
    ``output_rows``: a key whose merged output exceeds this is hot.
    ``spine_rows``: so is one whose merged output exceeds this, since a task holds
    all rows of one spine row at a time; its cells are as large as the others allow.

    Counts are exact and every such key is split; there is no bound on how many
    keys are hot or on how far one is split.
    """

    enabled: bool = True
    input_rows: int = 2_000_000
    output_rows: int = 20_000_000
    spine_rows: int = 100_000


def participants(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    key: str,
    order: Sequence[str] | None = None,
    include_unkeyed: bool = False,
) -> tuple[list[str], list[str]]:
    """(merged datasets in order, skipped datasets)."""
    names = list(order) if order is not None else sorted(datasets)
    feat = hmap.feature(key)
    if feat is None:
        raise KeyError(f"merge key {key!r} is not a feature of the map")
    keep, skipped = [], []
    for n in names:
        keyed = find_column(datasets[n].columns, feat.candidates(n)) is not None
        if keyed or include_unkeyed:
            keep.append(n)
        else:
            skipped.append(n)
    return keep, skipped


def _renamed_parts(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    names: list[str],
    key: str,
    prune_null: bool,
    key_state: str | None = None,
    types: Mapping[str, T.DataType] | None = None,
) -> tuple[list[DataFrame], list[str]]:
    """Standardized, suffix-renamed inputs in merge order, plus the output column order.

    ``key_state`` ("null" / "not_null") restricts rows by the key. When the key
    column reaches the canonical type without a fallible cast, the test is put
    on the raw column so Parquet can skip row groups by their null counts.
    """
    from canonix.operators.standardize import _safe_cast

    types = types or feature_types(hmap, {n: datasets[n] for n in names})
    kfeat = hmap.feature(key)
    parts, order, seen = [], [], set()
    for i, n in enumerate(names):
        raw = datasets[n]
        post = None
        if key_state is not None:
            physical = {f.name: f.dataType for f in raw.schema.fields}
            raw_cols = list(physical)
            found = find_column(raw_cols, kfeat.candidates(n))
            if found is None:
                raw_pred = F.lit(key_state == "null")
            else:
                phys = physical[found]
                if phys == types[key] or _safe_cast(phys, types[key]) or not isinstance(types[key], T.AtomicType):
                    c = F.col(quote(found))
                    raw_pred = c.isNull() if key_state == "null" else c.isNotNull()
                else:
                    raw_pred = None
                    kc = F.col(quote(key))
                    post = kc.isNull() if key_state == "null" else kc.isNotNull()
            if raw_pred is not None and found is not None and len({c.lower() for c in raw_cols}) == len(raw_cols):
                raw = raw.where(raw_pred)
            elif raw_pred is not None:
                post = F.col(quote(key)).isNull() if key_state == "null" else F.col(quote(key)).isNotNull()
        std = standardize(raw, n, hmap, types)
        if post is not None:
            std = std.where(post)
        cols = []
        for f in hmap.features:
            c = f.canonical_name
            if c == key:
                cols.append(quote(c))
                if i == 0:
                    order.append(c)
                continue
            if prune_null and not f.candidates(n):
                continue
            new = c if i == 0 else c + suffix_for(n)
            if new in seen or new == key:
                raise ValueError(f"merged column name {new!r} is produced twice")
            seen.add(new)
            cols.append(f"{quote(c)} AS {quote(new)}")
            order.append(new)
        parts.append(std.selectExpr(*cols))
    if key not in order:
        order.insert(0, key)
    return parts, order


def _null_columns(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    names: list[str],
    key: str,
    types: Mapping[str, T.DataType],
) -> dict[str, T.DataType]:
    """Merged columns that no input column feeds, with their types."""
    out = {}
    for i, n in enumerate(names):
        raw_cols = datasets[n].columns
        for f in hmap.features:
            c = f.canonical_name
            if c != key and find_column(raw_cols, f.candidates(n)) is None:
                out[c if i == 0 else c + suffix_for(n)] = types[c]
    return out


def merge_by_key(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    key: str,
    order: Sequence[str] | None = None,
    strategy: str = "auto",
    include_unkeyed: bool = False,
    prune_null: bool = False,
    key_filter: Column | None = None,
    skew: SkewConfig | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Merge ``datasets`` (raw, un-standardized) on canonical ``key``.

    ``strategy``: ``"layout"`` (above), ``"auto"`` (a single full outer join for two datasets, the
    key spine from three on, where the chain would re-shuffle its growing
    accumulated side at every step), ``"spine"`` or ``"chain"``.
    ``key_filter`` is an optional predicate on the key column, applied to every
    input before joining (used by merge-then-filter on the key).
    ``max_rows``: when given, the exact output size is computed first from the
    key counts (one pre-aggregated pass, no join) and a larger merge raises
    ``MergeTooLarge`` instead of running.
    """
    names, skipped = participants(hmap, datasets, key, order, include_unkeyed)
    if skipped:
        warnings.warn(f"datasets without a column for {key!r} are skipped: {', '.join(skipped)}", stacklevel=2)
    if not names:
        raise ValueError(f"no dataset maps the merge key {key!r}")
    if strategy == "auto":
        strategy = "chain" if len(names) <= 2 else "spine"
    if strategy not in ("spine", "chain", "layout"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    skew = skew or SkewConfig()
    types = feature_types(hmap, {n: datasets[n] for n in names})
    if strategy == "layout":
        copies, out_cols = _renamed_parts(hmap, datasets, names, key, prune_null, None, types)
        if key_filter is not None:
            copies = [p.where(key_filter) for p in copies]
        copies = [_copied(p, "merge-copy") for p in copies]
        keyed = [p.where(F.col(quote(key)).isNotNull()) for p in copies]
        null_rows = [p.where(F.col(quote(key)).isNull()) for p in copies]
        parts = keyed
    elif strategy == "chain":
        # one scan per dataset: null keys ride along (a null key never matches,
        # so each null-key row comes out once)
        parts, out_cols = _renamed_parts(hmap, datasets, names, key, prune_null, None, types)
        if key_filter is not None:
            parts = [p.where(key_filter) for p in parts]
        keyed, null_rows = parts, []
    else:
        keyed, out_cols = _renamed_parts(hmap, datasets, names, key, prune_null, "not_null", types)
        null_rows, _ = _renamed_parts(hmap, datasets, names, key, prune_null, "null", types)
        if key_filter is not None:
            keyed = [p.where(key_filter) for p in keyed]
            null_rows = [p.where(key_filter) for p in null_rows]
        parts = keyed
    # Columns without a source are no part of any join: the result has them as null literals.
    nulls = _null_columns(hmap, datasets, names, key, types)
    parts, null_rows = ([p.select(*[quote(c) for c in p.columns if c not in nulls]) for p in ps] for ps in (parts, null_rows))
    if max_rows is not None:
        total, too_many = merge_size(parts + null_rows, key)
        size = total.select("total", too_many.alias("over")).first()  # one row
        if size["over"] or (size["total"] or 0) > max_rows:
            rows = "over 9.2e18" if size["over"] else size["total"]
            raise MergeTooLarge(f"merge on {key!r} would produce {rows} rows (limit {max_rows})")
    hot = find_hot_keys(parts, key, skew) if skew.enabled else None
    branches = []
    if hot is not None:
        # null keys survive the anti join (null never equals a hot key)
        normal = [p.join(hot.select(key), on=key, how="left_anti") for p in parts]
        # First in the union: were an empty branch first, its removal at run time would put a projection over
        # the union, and every row would be written again.
        branches.append(_salted_branch(parts, key, hot, skew))
    else:
        normal = parts
    if strategy == "chain":
        merged = normal[0]
        for p in normal[1:]:
            merged = merged.join(p, on=key, how="full")
        branches.append(merged)
    else:
        if strategy == "layout":
            normal = [_bucketed(p, key) for p in normal]
        branches.append(_plain_spine(normal, key))
        branches += null_rows
    merged = _union_all(branches)
    return merged.selectExpr(*[f"CAST(NULL AS {nulls[c].simpleString()}) AS {quote(c)}" if c in nulls else quote(c) for c in out_cols])


def _union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _copied(df: DataFrame, name: str) -> DataFrame:
    """:func:`_written`, whatever the column names are."""
    return _written(df.toDF(*[f"c{i}" for i in range(len(df.columns))]), name).toDF(*df.columns)


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` by way of a table in the shared folder, bucketed and sorted by ``key``, one file a bucket.

    As many buckets as shuffle partitions, so that joins on the key take them as they are. The table
    (``canonix_merge_<id>``, outside of the warehouse) is only known to the session's catalog.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "merge-buckets")
    name = "canonix_merge_" + path.rsplit("-", 1)[-1]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    by = f"c{df.columns.index(key)}"
    plain.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    return spark.table(name).toDF(*df.columns)


def _plain_spine(keyed: list[DataFrame], key: str) -> DataFrame:
    spine = reduce(lambda a, b: a.union(b), [p.select(quote(key)) for p in keyed]).distinct()
    acc = spine
    for p in keyed:
        acc = acc.join(p, on=key, how="left")
    return acc


# ---------------------------------------------------------------------------
# Key statistics and hot keys
# ---------------------------------------------------------------------------

def key_counts(keyed: list[DataFrame], key: str) -> DataFrame:
    """Per key, the row count in each dataset: ``(key, n0, n1, ...)``.

    Only the key column is scanned, and the counts are combined map-side before
    the shuffle, so even a key holding a third of all rows costs one row per
    map task.
    """
    tagged = reduce(
        lambda a, b: a.union(b),
        [p.select(F.col(quote(key)).alias(_KEY_TMP), F.lit(i).alias("__i")) for i, p in enumerate(keyed)],
    )
    aggs = [F.count_if(F.col("__i") == i).alias(f"n{i}") for i in range(len(keyed))]
    return tagged.groupBy(_KEY_TMP).agg(*aggs)


def _product(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a * b, [F.greatest(c.cast("double"), F.lit(1.0)) for c in cols])


def merge_size(parts: list[DataFrame], key: str) -> tuple[DataFrame, Column]:
    """One row with the exact size ``total``, and a test that it exceeds a bigint (``total`` is then of no use).

    Products and sums are decimals; a double beside them, never inexact by more than rounding, tells overflow.
    """
    stats = key_counts(parts, key)
    counts = [F.col(f"n{i}") for i in range(len(parts))]
    rows_of_null = reduce(lambda a, b: a + b, counts)
    exact = F.lit(1).cast("decimal(38,0)")
    for c in counts:
        exact = F.try_multiply(exact, F.greatest(c, F.lit(1)).cast("decimal(19,0)")).cast("decimal(38,0)")
    null_key = F.col(_KEY_TMP).isNull()
    total = stats.agg(
        F.try_sum(F.when(null_key, rows_of_null.cast("decimal(38,0)")).otherwise(exact)).alias("total"),
        F.sum(F.when(null_key, rows_of_null.cast("double")).otherwise(_product(counts))).alias("about"))
    return total, F.coalesce(F.col("about"), F.lit(0.0)) >= F.lit(9.2e18)


def merge_row_count(parts: list[DataFrame], key: str) -> DataFrame:
    """Exact merged row count without joining (R5 size guard).

    ``sum over keys of prod_i max(1, n_i(k))``; the null-key group counts each
    of its rows once (null keys never match). One pre-aggregated pass over the
    key columns.
    """
    total, too_many = merge_size(parts, key)
    return total.select(F.when(~too_many, F.col("total")).cast("bigint").alias("rows"))


def find_hot_keys(keyed: list[DataFrame], key: str, skew: SkewConfig) -> DataFrame | None:
    """All keys too heavy for one task: ``(key, n0, n1, ...)``, or ``None`` where there are none.

    The table is written to the shared folder and read again, so joins with it
    are planned by its real size: small ones are broadcast by Spark's own
    threshold, larger ones shuffled.
    """
    cols = [F.col(f"n{i}") for i in range(len(keyed))]
    biggest = F.greatest(*cols) if len(cols) > 1 else cols[0]
    heavy = (biggest > skew.input_rows) | (_product(cols) > min(skew.output_rows, skew.spine_rows))
    stats = key_counts(keyed, key).where(F.col(_KEY_TMP).isNotNull() & heavy)
    hot = _written(stats.select(F.col(_KEY_TMP).alias(key), *cols), "hot-keys")
    return None if hot.isEmpty() else hot


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` by way of the shared folder: rows and their ids stay as they are when a task is retried."""
    out = scratch_path(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def _split(a: int, b: int, skew: SkewConfig) -> tuple[int, int]:
    """Groups per side for one key: bounded input per cell and output per cell.

    Reference form of :func:`_split_cols` (same rule on Python numbers).
    """
    if b == 0:
        return 1, 1
    sa = max(1, math.ceil(a / skew.input_rows))
    sb = max(1, math.ceil(b / skew.input_rows))
    need = a * b / skew.output_rows
    if sa * sb < need:
        sa = max(sa, math.ceil(math.sqrt(need * a / b)))
        sb = max(sb, math.ceil(math.sqrt(need * b / a)))
    return int(min(sa, a)), int(min(sb, b))


def _split_cols(a: Column, b: Column, skew: SkewConfig) -> tuple[Column, Column]:
    """:func:`_split` as column expressions over the hot-key table."""
    a, b = a.cast("double"), b.cast("double")
    sa0 = F.greatest(F.lit(1.0), F.ceil(a / skew.input_rows).cast("double"))
    sb0 = F.greatest(F.lit(1.0), F.ceil(b / skew.input_rows).cast("double"))
    need = a * b / skew.output_rows
    grow = sa0 * sb0 < need
    sa1 = F.when(grow, F.greatest(sa0, F.ceil(F.sqrt(need * a / b)).cast("double"))).otherwise(sa0)
    sb1 = F.when(grow, F.greatest(sb0, F.ceil(F.sqrt(need * b / a)).cast("double"))).otherwise(sb0)
    sa, sb = F.least(sa1, a), F.least(sb1, b)
    zero = b <= 0
    return (F.when(zero, 1).otherwise(sa.cast("int")), F.when(zero, 1).otherwise(sb.cast("int")))


def _cells(a: Column, b: Column, skew: SkewConfig) -> tuple[Column, Column]:
    """Groups per side for one key: :func:`_split_cols`, the dataset's side in groups of about ``CELL_ROWS`` at most."""
    sa, sb = _split_cols(a, b, skew)
    return sa, F.greatest(sb, F.ceil(b / CELL_ROWS).cast("int"))


def _hot_steps(hot: DataFrame, n: int, skew: SkewConfig) -> tuple[list[tuple[int, Column, Column]], list[int]]:
    """The joins of the hot branch, datasets of fewer rows first: (dataset, rows before it, its rows), and each join's tasks."""
    rows = hot.agg(*[F.sum(f"n{i}") for i in range(n)]).first()
    order = sorted(range(n), key=lambda i: (rows[i], i))
    steps = [(i, _product([F.col(f"n{j}") for j in order[:at]]) if at else F.lit(1.0), F.col(f"n{i}")) for at, i in enumerate(order)]
    work = []
    for _, a, b in steps:
        sa, sb = _cells(a, b, skew)
        work.append(F.sum(a * F.greatest(b, F.lit(1)) / TASK_OUTPUT + (a * sb + b * sa) / TASK_INPUT))
    tasks = hot.agg(*work).first()  # one row
    return steps, [int(min(max(1, math.ceil(t)), MAX_TASKS)) for t in tasks]


def _salted_branch(keyed: list[DataFrame], key: str, hot: DataFrame, skew: SkewConfig) -> DataFrame:
    hot_keys = hot.select(key)
    acc = hot_keys
    rid_cols: list[str] = []
    for (i, a, b), tasks in zip(*_hot_steps(hot, len(keyed), skew)):
        sa, sb = _cells(a, b, skew)
        plan = hot.select(key, sa.alias("__sa_n"), sb.alias("__sb_n"))
        rid = f"__rid{i}"
        # Row ids keep identical copies of a row apart when salting. They are written
        # with the rows first, so a retried task sees the same ids whatever the input.
        numbered = keyed[i].join(hot_keys, on=key, how="left_semi").withColumn(rid, F.monotonically_increasing_id())
        rows = _written(numbered, "hot-rows")
        # A key without rows in this dataset has one row of nulls instead, so that no row needs an outer join.
        rows = rows.unionByName(hot.where(F.col(f"n{i}") == 0).select(key), allowMissingColumns=True)
        right = (
            rows.join(plan, on=key)
            .withColumn("__sb", F.pmod(F.xxhash64(F.col(rid)), F.col("__sb_n")).cast("int"))
            .withColumn("__sa", F.explode(F.sequence(F.lit(0), F.col("__sa_n") - 1)))
            .drop("__sa_n", "__sb_n")
        )
        left = (
            acc.join(plan, on=key)
            .withColumn("__sa", F.pmod(F.xxhash64(F.lit(0), *[F.col(r) for r in rid_cols]), F.col("__sa_n")).cast("int"))
            .withColumn("__sb", F.explode(F.sequence(F.lit(0), F.col("__sb_n") - 1)))
            .drop("__sa_n", "__sb_n")
        )
        # Tasks by the rows that come out: the few bytes that go in would be read by a few tasks,
        # and a broadcast side is larger than its file, by its copies.
        cell = [key, "__sa", "__sb"]
        acc = left.repartition(tasks, *cell).join(right.repartition(tasks, *cell).hint("merge"), on=cell).drop("__sa", "__sb")
        rid_cols.append(rid)
    return acc.drop(*rid_cols)
