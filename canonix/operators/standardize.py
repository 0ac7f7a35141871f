"""Standardize datasets to the map's canonical schema (one ``select`` per dataset).

Invariants (kept from the reference semantics):

1. Output columns are the map's canonical names, in map order.
2. Per feature, the first listed candidate present in the dataset wins;
   later candidates are ignored (schema-level pick, not a row-wise coalesce).
3. Name matching is exact and case-sensitive.
4. One original column may feed several features.

Columns of a basic type are ``try_cast`` to the declared type (``Integer`` ->
bigint, ``Float`` -> double, ``String`` -> string), so mixed physical types join
cleanly under ANSI mode. Columns whose physical type is outside the declared
vocabulary (timestamp, date, binary, nested) pass through untouched where all datasets of the feature agree on it, and the
null fill elsewhere uses the same physical type. Where they do not agree, a declared String is text in all of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from canonix.model import HarmonizationMap, declared_type, is_basic_type, quote


def find_column(columns: list[str], candidates: list[str]) -> str | None:
    """First candidate present in ``columns`` (exact, case-sensitive)."""
    present = set(columns)
    for c in candidates:
        if c in present:
            return c
    return None


def _positional(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Rename columns positionally when names clash under case-insensitive resolution."""
    columns = columns if columns is not None else df.columns
    lowered = [c.lower() for c in columns]
    if len(set(lowered)) == len(lowered):
        return df, {c: c for c in columns}
    names = [f"__c{i}" for i in range(len(columns))]
    return df.toDF(*names), dict(zip(columns, names))


def feature_types(hmap: HarmonizationMap, datasets: Mapping[str, DataFrame]) -> dict[str, T.DataType]:
    """Output type per feature: declared, unless all mapped columns share one physical type outside the vocabulary."""
    schemas = {name: {f.name: f.dataType for f in df.schema.fields} for name, df in datasets.items()}
    out: dict[str, T.DataType] = {}
    for f in hmap.features:
        found = [(fields, find_column(list(fields), f.candidates(name))) for name, fields in schemas.items()]
        physical = [fields[c] for fields, c in found if c is not None]
        agree = physical and not is_basic_type(physical[0]) and all(p == physical[0] for p in physical)
        out[f.canonical_name] = physical[0] if agree else declared_type(f.data_type)
    return out


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _safe_cast(physical: T.DataType, target: T.DataType) -> bool:
    """Casts that can never fail: widening numbers, anything to string."""
    if isinstance(target, T.StringType):
        return True
    if isinstance(target, T.LongType):
        return isinstance(physical, _INTEGRAL)
    if isinstance(target, T.DoubleType):
        return isinstance(physical, _INTEGRAL + (T.FloatType, T.DoubleType))
    return False


_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def cast_sql(name_sql: str, physical: T.DataType, target: T.DataType) -> str:
    """Cast text to the declared type for an already quoted column reference.

    Plain ``CAST`` when it cannot fail (keeps predicates on it pushable to the
    scan), ``TRY_CAST`` otherwise (a bad cell becomes null under ANSI mode).

    A fractional number declared ``Integer``, also one in text, converts only when it is
    whole (``1.0`` -> ``1``); ``1.5`` becomes null instead of being truncated.
    """
    if not is_basic_type(physical) or physical == target:
        return name_sql
    if isinstance(physical, _FRACTIONAL) and isinstance(target, T.LongType):
        return f"CASE WHEN {name_sql} = floor({name_sql}) THEN TRY_CAST({name_sql} AS BIGINT) END"
    if isinstance(physical, T.StringType) and isinstance(target, T.LongType):
        number = f"TRY_CAST({name_sql} AS DECIMAL(38, 9))"
        return (f"COALESCE(TRY_CAST({name_sql} AS BIGINT), "
                f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS BIGINT) END)")
    fn = "CAST" if _safe_cast(physical, target) else "TRY_CAST"
    return f"{fn}({name_sql} AS {target.simpleString()})"


def standardize_exprs(
    columns: Mapping[str, T.DataType],
    dataset: str,
    hmap: HarmonizationMap,
    types: Mapping[str, T.DataType] | None = None,
    cast: bool = True,
    rename: Mapping[str, str] | None = None,
) -> list[str]:
    """SQL select-list of the canonical projection of a dataset with these physical columns.

    Built as expression text so the whole projection is one ``selectExpr``
    call, however wide the map is.
    """
    original = list(columns)
    exprs = []
    for f in hmap.features:
        target = (types or {}).get(f.canonical_name) or declared_type(f.data_type)
        found = find_column(original, f.candidates(dataset))
        out = quote(f.canonical_name)
        if found is not None:
            src = quote((rename or {}).get(found, found))
            if not cast or is_basic_type(columns[found]) or types is None or columns[found] == target:
                e = cast_sql(src, columns[found], target) if cast else src
            elif isinstance(target, T.StringType):
                e = f"CAST({src} AS STRING)"  # a date here, text in another dataset: both are text
            else:
                e = f"CAST(NULL AS {target.simpleString()})"
            exprs.append(f"{e} AS {out}")
        else:
            exprs.append(f"CAST(NULL AS {target.simpleString()}) AS {out}")
    return exprs


def standardize(
    df: DataFrame,
    dataset: str,
    hmap: HarmonizationMap,
    types: Mapping[str, T.DataType] | None = None,
    cast: bool = True,
) -> DataFrame:
    """Project ``df`` onto the map's canonical columns."""
    physical = {f.name: f.dataType for f in df.schema.fields}  # one schema lookup
    df2, rename = _positional(df, list(physical))
    return df2.selectExpr(*standardize_exprs(physical, dataset, hmap, types, cast, rename))


def standardize_all(
    datasets: Mapping[str, DataFrame],
    hmap: HarmonizationMap,
    only_mapped: bool = True,
) -> dict[str, DataFrame]:
    """Standardize every dataset with consistent null-fill types across them."""
    types = feature_types(hmap, datasets)
    mapped = set(hmap.datasets())
    return {
        name: standardize(df, name, hmap, types)
        for name, df in datasets.items()
        if not only_mapped or name in mapped
    }


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip whitespace around column names; raise if that makes two names equal (P5)."""
    stripped = [c.strip() for c in df.columns]
    if len(set(stripped)) != len(stripped):
        dup = sorted({c for c in stripped if stripped.count(c) > 1})
        raise ValueError(f"header trim creates duplicate column names: {dup}")
    if stripped == df.columns:
        return df
    return df.toDF(*stripped)


def suffix_for(dataset: str) -> str:
    """Collision suffix used for the 2nd and later datasets of a merge."""
    return "_from_" + dataset.replace(".", "_")
