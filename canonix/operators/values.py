"""Distinct values of canonical features.

Every operator returns a DataFrame; nothing is collected. Distinct runs as a
partial (map-side) aggregate before its shuffle, so a value repeated in a third
of all rows costs one row per map task.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.functions.text import canonical_string
from canonix.model import HarmonizationMap, quote
from canonix.operators.standardize import feature_types, standardize


def _empty(spark: SparkSession, name: str, dtype: T.DataType = T.StringType()) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(name, dtype)]))


def unique_values_across(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    feature: str,
    include_null: bool = False,
    sort: bool = True,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Sorted distinct text values of ``feature`` over the datasets the map lists for it (A4).

    A dataset named by the map but absent from ``datasets`` is skipped, as an
    unreadable file is. Output column: the feature name.
    """
    f = hmap.feature(feature)
    listed = [n for n in (f.original_columns if f else {}) if n in datasets]
    if not listed:
        if f is None:
            warnings.warn(f"canonical feature {feature!r} not in the map", stacklevel=2)
        spark = spark or SparkSession.getActiveSession()
        return _empty(spark, feature)
    types = feature_types(hmap, {n: datasets[n] for n in listed})
    # Integers and strings have one text per value, so the distinct can run on the
    # narrower native value and the text is made after it; other types (e.g.
    # doubles, where -0.0 and 0.0 are one value but two texts) go to text first.
    native = isinstance(types[feature], (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType))
    fc = F.col(quote(feature))
    parts = [standardize(datasets[n], n, hmap, types).select(fc if native else canonical_string(fc).alias(feature))
             for n in listed]
    out = reduce(lambda a, b: a.union(b), parts)
    if not include_null:
        out = out.where(fc.isNotNull())
    out = out.distinct()
    if native:
        out = out.select(canonical_string(fc).alias(feature))
    if sort:
        out = out.orderBy(F.col(quote(feature)).asc_nulls_first())
    return out


def unique_values_df(df: DataFrame, feature: str) -> DataFrame:
    """Distinct values of one column of a DataFrame, native type, null included (A5)."""
    if feature not in df.columns:
        warnings.warn(f"column {feature!r} not in the DataFrame", stacklevel=2)
        return _empty(df.sparkSession, feature)
    return df.select(F.col(quote(feature))).distinct()


def unique_values_single(df: DataFrame, dataset: str, hmap: HarmonizationMap, feature: str) -> DataFrame:
    """Distinct text values of a feature in one dataset, null included."""
    if hmap.feature(feature) is None:
        warnings.warn(f"canonical feature {feature!r} not in the map", stacklevel=2)
        return _empty(df.sparkSession, feature)
    std = standardize(df, dataset, hmap)
    return std.select(canonical_string(F.col(quote(feature))).alias(feature)).distinct()


def distinct_union(frames: Sequence[DataFrame], column: str) -> tuple[DataFrame | None, list[int]]:
    """Union of one named column over the frames that have it; indexes of skipped frames."""
    have, skipped = [], []
    for i, df in enumerate(frames):
        if column in df.columns:
            have.append(df.select(canonical_string(F.col(quote(column))).alias(column)))
        else:
            skipped.append(i)
    if not have:
        return None, skipped
    return reduce(lambda a, b: a.union(b), have), skipped


def consolidate_values(frames: Sequence[DataFrame], column: str, prior: DataFrame | None = None) -> DataFrame:
    """Distinct, sorted, non-null values of ``column`` over frames plus a prior output."""
    pool = list(frames) + ([prior] if prior is not None else [])
    out, _ = distinct_union(pool, column)
    if out is None:
        spark = SparkSession.getActiveSession()
        return _empty(spark, column)
    return out.where(F.col(quote(column)).isNotNull()).distinct().orderBy(F.col(quote(column)))


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly under ``path`` that a finished write has marked with ``_SUCCESS``."""
    from canonix.session import hadoop_exists, hadoop_list

    return sorted(p for p, is_file in hadoop_list(spark, path) if not is_file and hadoop_exists(spark, p + "/_SUCCESS"))


def _versions(spark: SparkSession, output_path: str) -> tuple[int, list[str]]:
    """(number, folders) of the latest complete version: its base ``v-<n>`` and the deltas ``v-<n>-d-<k>`` written after it."""
    found: dict[int, dict[int, str]] = {}
    for path in complete_folders(spark, output_path):
        m = re.fullmatch(r"v-(\d+)(?:-d-(\d+))?", path.rstrip("/").rsplit("/", 1)[-1])
        if m:
            found.setdefault(int(m[1]), {})[int(m[2] or 0)] = path
    whole = [n for n, parts in found.items() if 0 in parts]
    return (max(whole), [p for _, p in sorted(found[max(whole)].items())]) if whole else (0, [])


def _read_versions(spark: SparkSession, paths: Sequence[str], column: str | None = None) -> DataFrame:
    """The values of a base and its deltas, as they were written (a delta holds none that the others have)."""
    from canonix.sources.tables import read_csv

    parts = [read_csv(spark, p, infer=False) for p in paths]
    return reduce(lambda a, b: a.union(b), [p if column is None else p.select(F.col(quote(column))) for p in parts])


def read_consolidated_csv(spark: SparkSession, output_path: str) -> DataFrame | None:
    """The latest complete version of a consolidated output, or ``None``."""
    paths = _versions(spark, output_path)[1]
    return _read_versions(spark, paths) if paths else None


def distinct_consolidate(
    spark: SparkSession,
    input_paths: Sequence[str],
    column: str,
    output_path: str,
    reader=None,
    merge_every: int = 8,
) -> tuple[DataFrame, list[str]]:
    """Incremental distinct consolidation to a versioned CSV folder.

    The first run writes the sorted distinct values of the column of every readable input that has it as
    the base ``v-1``. A later run writes only the values that the base and its deltas do not hold (an anti join) as
    the next delta, and nothing when there are none; in place of delta number ``merge_every`` a new base with all values is
    written. Values are text and stay as they are: quotes, line breaks, leading zeros. Nothing is
    renamed or deleted: a folder counts once its ``_SUCCESS`` marker exists,
    so a run that dies midway leaves the previous result in place.
    Returns all values, sorted, and the list of skipped inputs.
    """
    from canonix.operators.merge import _copied
    from canonix.sources.sinks import write_csv
    from canonix.sources.tables import read_dataset

    reader = reader or (lambda p: read_dataset(spark, p, infer=False))
    frames, skipped = [], []
    for p in input_paths:
        try:
            df = reader(p)
        except Exception:  # unreadable or unsupported file: report and go on
            df = None
        if df is None or column not in df.columns:
            skipped.append(p)
            continue
        frames.append(df)
    number, paths = _versions(spark, output_path)
    found = consolidate_values(frames, column)
    root = output_path.rstrip("/")
    if not paths:
        write_csv(found, f"{root}/v-1")
        return _sorted(_read_versions(spark, [f"{root}/v-1"]), column), skipped
    prior = _read_versions(spark, paths, column)
    new = _copied(found.join(prior, column, "left_anti"), "new-values")
    if not new.isEmpty():
        if len(paths) < merge_every:
            paths.append(f"{root}/v-{number}-d-{len(paths)}")
            write_csv(_sorted(new, column), paths[-1])
        else:
            paths = [f"{root}/v-{number + 1}"]
            write_csv(_sorted(prior.union(new), column), paths[0])  # range-partitioned: no single task
    return _sorted(_read_versions(spark, paths, column), column), skipped


def _sorted(values: DataFrame, column: str) -> DataFrame:
    return values.orderBy(F.col(quote(column)))
