"""Filters on canonical values.

The reference compares ``cast(column as string) == value``. A string cast hides
the column from Parquet pushdown, so integral columns compare typed when the
value is the canonical text of an integer that fits the type; any other text
can never equal an integer's string form, so the predicate is constant false.
Both forms return exactly the rows of the string comparison.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.functions.text import canonical_string
from canonix.model import HarmonizationMap, quote

_CANONICAL_INT = re.compile(r"^(0|-?[1-9][0-9]*)$")

_INT_RANGES = {
    T.ByteType: 8,
    T.ShortType: 16,
    T.IntegerType: 32,
    T.LongType: 64,
}


def value_predicate(c: Column, dtype: T.DataType, value: str) -> Column:
    """Rows where ``cast(c as string) == value`` (null never matches)."""
    for t, bits in _INT_RANGES.items():
        if isinstance(dtype, t):
            if not _CANONICAL_INT.match(value):
                return F.lit(False)
            v = int(value)
            if not -(2 ** (bits - 1)) <= v < 2 ** (bits - 1):
                return F.lit(False)
            return c == F.lit(v).cast(dtype)
    if isinstance(dtype, T.StringType):
        return c == F.lit(value)
    return canonical_string(c) == F.lit(value)


def suffixed_columns(df: DataFrame, feature: str, suffixes: Sequence[str] | None = None) -> list[str]:
    """The feature's unsuffixed column plus its columns of later merged datasets.

    ``suffixes`` names those datasets' suffixes exactly; without them every ``<feature>_from_*`` column counts.
    """
    out = [feature] if feature in df.columns else []
    if suffixes is not None:
        return out + [feature + x for x in suffixes if feature + x in df.columns]
    out += [c for c in df.columns if c.startswith(feature + "_from_")]
    return out


def filter_by_value(df: DataFrame, feature: str, value: str, scope: str = "first",
                    suffixes: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose canonical feature equals ``value`` as text (F1, F2).

    ``scope="first"`` tests only the unsuffixed column (the first merged
    dataset's values, as the reference does); ``scope="any"`` ORs over the
    feature's suffixed columns too.
    """
    if feature not in df.columns:
        warnings.warn(f"canonical feature {feature!r} not in the DataFrame; returning no rows", stacklevel=2)
        return df.limit(0)
    cols = [feature] if scope == "first" else suffixed_columns(df, feature, suffixes)
    if scope not in ("first", "any"):
        raise ValueError(f"unknown scope {scope!r}")
    schema = {f.name: f.dataType for f in df.schema.fields}
    preds = [value_predicate(F.col(quote(c)), schema[c], value) for c in cols]
    cond = preds[0]
    for p in preds[1:]:
        cond = cond | p
    return df.where(cond)


def merge_then_filter(
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    feature: str,
    value: str,
    key: str | None = None,
    order: Sequence[str] | None = None,
    scope: str = "first",
    strategy: str = "auto",
    **merge_kwargs,
) -> DataFrame:
    """Merge everything on ``key`` (default: the map's first feature), then filter.

    When the filter is on the merge key itself, the predicate is given to the
    merge so it is applied to every input before any join.
    """
    from canonix.operators.merge import merge_by_key, participants
    from canonix.operators.standardize import feature_types, suffix_for

    key = key or hmap.features[0].canonical_name
    key_filter = None
    if feature == key:
        names, _ = participants(hmap, datasets, key, order, merge_kwargs.get("include_unkeyed", False))
        key_type = feature_types(hmap, {n: datasets[n] for n in names})[key]
        key_filter = value_predicate(F.col(quote(key)), key_type, value)
    merged = merge_by_key(hmap, datasets, key, order=order, strategy=strategy, key_filter=key_filter,
                          **merge_kwargs)
    return filter_by_value(merged, feature, value, scope=scope, suffixes=[suffix_for(n) for n in datasets])
