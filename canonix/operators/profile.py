"""Dataset profiling.

All statistics of one dataset come from one pass: row count and per-column
null counts are a single ``agg`` (partial aggregation per task, one row per
task shuffled). Unique samples over whole columns take a few rounds of such an
aggregate, so no column's values ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import quote
from canonix.session import ensure_checkpoint_dir


def _null_test(field: T.StructField) -> Column:
    c = F.col(quote(field.name))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)  # NaN counts as missing, as in pandas
    return c.isNull()


def shape(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """``(dataset, rows, cols)`` of the full table (A1)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(dataset).cast("string").alias("dataset"), F.col("rows"), F.lit(len(df.columns)).alias("cols")
    )


def null_counts(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Long table ``(dataset, position, column_name, null_count)`` plus the row count (A2).

    One aggregate over the table, then a narrow unpivot of that single row.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(_null_test(f)).alias(f"__n{i}") for i, f in enumerate(fields)
    ]
    one = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.col(f"__n{i}").alias("null_count"))
        for i, f in enumerate(fields)
    ])
    return one.select(F.col("__rows").alias("rows"), F.inline(entries)).select(
        F.lit(dataset).cast("string").alias("dataset"), "position", "column_name", "null_count", "rows"
    )


_FILE_ORDER = ("__file_path", "__row_index")


def _with_file_order(df: DataFrame) -> DataFrame | None:
    """``df`` plus its file position (Parquet: file path and row index), or ``None`` if unknown."""
    try:
        out = df.select("*", F.col("_metadata.file_path").alias(_FILE_ORDER[0]),
                        F.col("_metadata.row_index").alias(_FILE_ORDER[1]))
        _ = out.schema
        return out
    except Exception:  # not a file scan with row indexes (CSV, joins, local data)
        return None


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (S3, L2, K4); ``TakeOrderedAndProject`` keeps n per task.

    With ``order_by`` the order is named. Without it, a Parquet scan gives its
    rows in file order (file path, row index), which is what reading the first
    lines of a file means, and only the files that hold them are read; for CSV files see ``tables.read_head``.
    Other inputs fall back to ordering by every column.
    """
    return head_positioned(df, n, order_by).drop("__pos")


def head_positioned(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """:func:`head` plus ``__pos`` (1..n) in that order; the window runs over the n sampled rows only."""
    if not order_by:
        first = _first_of_files(df, n)
        if first is not None:
            return first
    keys = [F.col(quote(c)).asc_nulls_first() for c in order_by or df.columns]
    sample = df.orderBy(*keys).limit(n)
    return sample.withColumn("__pos", F.row_number().over(Window.orderBy(*keys)))


def _first_of_files(df: DataFrame, n: int) -> DataFrame | None:
    """The first ``n`` rows of a scan that knows its file order, files by name, or ``None`` for anything else.

    The files are read one after the other until there are n rows, which pass the driver; no other file is read.
    """
    positioned = _with_file_order(df)
    if positioned is None:
        return None
    path, index = _FILE_ORDER
    got: list = []
    for f in sorted(positioned.inputFiles()):
        name = f.replace("file:///", "file:/", 1)
        rows = positioned.filter(F.col(path).isin(f, name)).orderBy(index).limit(n - len(got)).drop(path, index).collect()
        got += [(*r, len(got) + i + 1) for i, r in enumerate(rows)]
        if len(got) >= n:
            break
    if not got and not positioned.isEmpty():
        return None  # paths are written in another way here
    schema = T.StructType([*df.schema.fields, T.StructField("__pos", T.IntegerType())])
    return df.sparkSession.createDataFrame(got, schema)


def _as_text(f: T.StructField) -> Column:
    return F.col(quote(f.name)).cast("string")


def unique_sample_head(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None,
                       dataset: str | None = None, sample: DataFrame | None = None) -> DataFrame:
    """Unique values of each column within the first ``n`` rows, in order of appearance (A3 head).

    Output ``(dataset, position, column_name, values array<string>)``; a null
    value is kept as a null element, as the reference keeps NaN.
    """
    sample = head_positioned(df, n, order_by) if sample is None else sample  # n rows
    fields = df.schema.fields
    stacked = sample.select(
        "__pos",
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), _as_text(f).alias("value"))
            for i, f in enumerate(fields)
        ])),
    )
    first = stacked.groupBy("position", "column_name", "value").agg(F.min("__pos").alias("first_pos"))
    return first.groupBy("position", "column_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("first_pos", "value"))), lambda s: s["value"]).alias("values")
    ).select(F.lit(dataset).cast("string").alias("dataset"), "position", "column_name", "values")


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _by_rounds(dt: T.DataType) -> bool:
    """Types whose text gives the value back, so that a value found can be compared with in the next round."""
    return isinstance(dt, T.AtomicType) and not isinstance(dt, T.BinaryType)


def unique_sample_full(df: DataFrame, n: int = 5, dataset: str | None = None) -> DataFrame:
    """The ``n`` smallest distinct values of each column over the whole table (A3 full).

    ``n`` rounds of one aggregate: the least value above the last one, for all columns at once. A round shuffles one
    row a task, whatever the number of distinct values, and brings one row to the driver; there are fewer
    rounds when no column has that many values. Nested and binary columns go another way (``_nested_sample``).
    """
    fields = df.schema.fields
    simple = [(i, f) for i, f in enumerate(fields) if _by_rounds(f.dataType)]
    found: dict[int, list[str]] = {i: [] for i, _ in simple}
    live = simple
    for _ in range(n):
        aggs = []
        for i, f in live:
            c = F.col(quote(f.name))
            if found[i]:
                c = F.when(c > F.lit(found[i][-1]).cast(f.dataType), c)
            aggs.append(F.min(c).cast("string").alias(f"c{i}"))
        row = df.agg(*aggs).first() if live else None
        live = [(i, f) for i, f in live if row[f"c{i}"] is not None]
        for i, _ in live:
            found[i].append(row[f"c{i}"])
        if not live:
            break
    schema = "dataset string, position int, column_name string, values array<string>"
    out = df.sparkSession.createDataFrame([(dataset, i, f.name, found[i]) for i, f in simple if found[i]], schema)
    nested = [(i, f) for i, f in enumerate(fields) if not _by_rounds(f.dataType)]
    return out.union(_nested_sample(df, nested, n, dataset)) if nested else out


def _nested_sample(df: DataFrame, fields: Sequence[tuple[int, T.StructField]], n: int, dataset: str | None) -> DataFrame:
    """:func:`unique_sample_full` of these columns through one plan: each cell becomes ``(position, key,
    text)``, where ``key`` is a struct with one slot per column type so every
    column keeps its native order. The distinct is a partial aggregate per
    task; ``row_number() <= n`` per column is planned with a per-task group
    limit before its shuffle, so at most n rows per column and task move.
    Columns of an unorderable type (maps) are ordered by their text.
    """
    slots: dict[str, T.DataType] = {}
    for _, f in fields:
        dt = f.dataType if _orderable(f.dataType) else T.StringType()
        slots.setdefault(dt.simpleString(), dt)
    names = list(slots)
    entries = []
    for i, f in fields:
        c = F.col(quote(f.name))
        dt = f.dataType if _orderable(f.dataType) else T.StringType()
        own = dt.simpleString()
        key = F.struct(*[
            ((c if _orderable(f.dataType) else c.cast("string")) if nm == own else F.lit(None).cast(slots[nm]))
            .alias(f"s{j}")
            for j, nm in enumerate(names)
        ])
        entries.append(F.struct(F.lit(i).alias("position"), key.alias("k"), c.cast("string").alias("value")))
    cells = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    w = Window.partitionBy("position").orderBy("k")
    top = cells.distinct().withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    by_col = top.groupBy("position").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__rn", "value"))), lambda x: x["value"]).alias("values"))
    names_df = df.sparkSession.createDataFrame([(i, f.name) for i, f in fields],
                                               "position int, column_name string")
    return by_col.join(F.broadcast(names_df), "position").select(
        F.lit(dataset).cast("string").alias("dataset"), "position", "column_name", "values")


def sample_json_records(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None,
                        sample: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows as one JSON array of records (P8, C12): ``(records string)``."""
    sample = head_positioned(df, n, order_by) if sample is None else sample  # n rows
    keyed = sample.select("__pos", F.struct(*[F.col(quote(c)) for c in df.columns]).alias("r"))
    return keyed.agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "r"))), lambda s: s["r"])).alias("records")
    )


def rows_as_json(df: DataFrame) -> DataFrame:
    """Every row as a JSON record (the at-scale form of P8)."""
    return df.select(F.to_json(F.struct("*")).alias("record"))


def dataset_profile(datasets: Mapping[str, DataFrame], sample_rows: int = 5,
                    order_by: Mapping[str, Sequence[str]] | None = None,
                    metadata: DataFrame | None = None, samples: bool = True,
                    heads: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Profile of every dataset (A8): ``(column_profile, dataset_profile)``.

    column_profile: ``dataset, position, column_name, data_type, null_count,
    unique_sample``. dataset_profile: ``dataset, rows, cols, sample_json,
    metadata``. Row count and null counts share one aggregate per dataset, its only whole scan; the head
    sample is taken once and serves both samples (``heads``: samples with ``__pos`` taken elsewhere, as of CSV files).
    The unique sample follows the reference (unique values within the head
    sample); ``samples=False`` skips the head samples (e.g. for the report,
    which only needs types, null counts and shapes).
    """
    spark = next(iter(datasets.values())).sparkSession
    ensure_checkpoint_dir(spark)
    # The one whole scan of each dataset; what it finds is written, as both profiles read it.
    counts = reduce(DataFrame.union, [null_counts(df, name) for name, df in datasets.items()]).checkpoint()
    col_parts, ds_parts = [], []
    for name, df in datasets.items():
        ob = (order_by or {}).get(name)
        fields = df.schema.fields
        types = spark.createDataFrame(
            [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
            "position int, column_name string, data_type string",
        )
        nc = counts.filter(F.col("dataset") == name)
        cp = nc.join(F.broadcast(types), ["position", "column_name"])
        sh = nc.groupBy("dataset").agg(F.max("rows").alias("rows")).withColumn("cols", F.lit(len(fields))) if fields else shape(df, name)
        if samples:
            sample = (heads or {}).get(name)
            if sample is None:
                sample = head_positioned(df, sample_rows, ob)
                if ob or _with_file_order(df) is None:  # n rows, kept so that both samples share their scan
                    sample = spark.createDataFrame(sample.collect(), sample.schema)
            us = unique_sample_head(df, sample_rows, ob, name, sample).select(
                "position", F.col("values").alias("unique_sample"))
            cp = cp.join(us, "position", "left")
            sj = sample_json_records(df, sample_rows, ob, sample).withColumn("dataset", F.lit(name))
            sh = sh.join(sj, "dataset", "left").withColumnRenamed("records", "sample_json")
        else:
            cp = cp.withColumn("unique_sample", F.lit(None).cast("array<string>"))
            sh = sh.withColumn("sample_json", F.lit(None).cast("string"))
        col_parts.append(cp.select("dataset", "position", "column_name", "data_type", "null_count",
                                   "unique_sample"))
        ds_parts.append(sh.select("dataset", "rows", "cols", "sample_json"))
    col_profile = col_parts[0]
    for p in col_parts[1:]:
        col_profile = col_profile.unionByName(p)
    ds_profile = ds_parts[0]
    for p in ds_parts[1:]:
        ds_profile = ds_profile.unionByName(p)
    if metadata is not None:
        ds_profile = ds_profile.join(metadata.select("dataset", F.col("metadata_text").alias("metadata")),
                                     "dataset", "left")
    else:
        ds_profile = ds_profile.withColumn("metadata", F.lit(None).cast("string"))
    return col_profile, ds_profile
