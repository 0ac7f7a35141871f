"""Table readers (S1, S2, S8 dispatch, S9) and folder loading.

* CSV, tolerant: header row, declared schema when known, bound by name; an
  unparseable cell becomes null (optionally keeping the record). See ``csvscan.py``.
* CSV with missing-value tokens: read as text, blank the tokens, ``try_cast``.
* Parquet: as is. Workbooks: see ``workbooks.py``.

Extension dispatch is case-insensitive (``.CSV`` is CSV). A dataset may be a
single file or a folder written by Spark (``orders.csv/part-*.csv``).
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import HarmonizationMap, declared_type, quote
from canonix.operators.standardize import trim_headers
from canonix.sources import csvscan

TABULAR_EXTENSIONS = (".csv", ".parquet", ".xlsx")
# pandas' default missing-value spellings that appear in practice (profile path option)
PANDAS_NA_TOKENS = ("", "NA", "N/A", "NULL", "NaN", "nan", "null", "None", "n/a", "#N/A", "-NaN", "-nan",
                    "<NA>", "1.#IND", "1.#QNAN", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN")


def extension_of(name: str) -> str:
    name = name.rstrip("/").rsplit("/", 1)[-1]
    return ("." + name.rsplit(".", 1)[1]).lower() if "." in name.lstrip(".") else ""


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    corrupt_column: str | None = None,
    infer: bool = True,
    multi_line: bool | None = None,
    na_tokens: Sequence[str] = (),
) -> DataFrame:
    """Tolerant CSV scan (S1): bad cells become null instead of failing the job.

    Quoted cells may hold doubled quotes and line breaks, and large files are split over tasks all the
    same (``csvscan``); ``multi_line=False`` promises that there are no such breaks.

    A ``schema`` is bound by the header's exact names, wherever they stand; a column that no header names is
    null. ``corrupt_column`` keeps the record where a cell does not fit. Without a schema, types come from a lattice
    folded over all cells (codes with leading zeros stay text), or all columns are text with ``infer=False``.
    """
    table = csvscan.text_table(spark, path, corrupt_column, multi_line)
    if schema is None:
        table = csvscan.typed(table, {}, na_tokens)
        types = csvscan.inferred_types(table.drop(corrupt_column) if corrupt_column else table) if infer else {}
        return csvscan.typed(table, types)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    at = {n: i for i, n in enumerate(table.columns)}
    absent = [f.name for f in st.fields if f.name not in at]
    if absent:
        warnings.warn(f"columns {absent} are not in the header of {path}", stacklevel=2)
    plain = table.toDF(*[f"c{i}" for i in range(len(at))])
    out, bad = [], F.lit(False)
    for f in st.fields:
        if f.name not in at:
            out.append(F.lit(None).cast(f.dataType))
            continue
        c = F.col(f"c{at[f.name]}")
        if na_tokens:
            c = F.when(c.isin(list(na_tokens)), F.lit(None).cast("string")).otherwise(c)
        cell = c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType)
        bad = bad | (c.isNotNull() & cell.isNull() & (c != ""))
        out.append(cell)
    names = [f.name for f in st.fields]
    if corrupt_column:
        out.append(F.when(bad, F.col(f"c{at[corrupt_column]}")))
        names.append(corrupt_column)
    return plain.select(*[c.alias(f"c{i}") for i, c in enumerate(out)]).toDF(*names)


def read_csv_na_tokens(
    spark: SparkSession,
    path: str | Sequence[str],
    types: dict[str, T.DataType] | None = None,
    na_tokens: Sequence[str] = ("",),
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV scan with a missing-value token list.

    Every cell is read as text; a cell equal to a token becomes null; columns
    named in ``types`` are then ``try_cast`` (a bad cell becomes null).
    """
    return csvscan.typed(csvscan.text_table(spark, path, over_lines=multi_line), types or {}, na_tokens)


def declared_schema_for(hmap: HarmonizationMap, dataset: str, header: Sequence[str]) -> T.StructType:
    """Schema for a CSV from the map's declared types (unmapped columns are strings)."""
    by_col: dict[str, T.DataType] = {}
    for f in hmap.features:
        for c in f.candidates(dataset):
            by_col.setdefault(c, declared_type(f.data_type))
    return T.StructType([T.StructField(h, by_col.get(h, T.StringType())) for h in header])


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = True,
                 na_tokens: Sequence[str] = (), multi_line: bool | None = None) -> DataFrame | None:
    """Read one dataset by extension; ``None`` for an unsupported extension."""
    ext = extension_of(path)
    if ext == ".csv":
        return read_csv(spark, path, schema, infer=infer, na_tokens=na_tokens, multi_line=multi_line)
    if ext == ".parquet":
        return spark.read.parquet(path)
    if ext == ".xlsx":
        from canonix.sources.workbooks import read_workbook_table

        return read_workbook_table(spark, path)
    return None


def read_head(spark: SparkSession, path: str, df: DataFrame, n: int = 5, na_tokens: Sequence[str] = ()) -> DataFrame | None:
    """The first ``n`` rows of a CSV dataset as its files have them, with ``__pos``, in the columns of ``df`` (S3);
    ``None`` for other kinds, whose scans know their order."""
    return csvscan.first_rows(spark, path, n, df.schema, na_tokens) if extension_of(path) == ".csv" else None


def load_folder(spark: SparkSession, folder: str, strict: bool = False, hmap: HarmonizationMap | None = None,
                na_tokens: Sequence[str] | None = None, multi_line: bool | None = None
                ) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Every tabular dataset directly under ``folder``: ``({name: df}, [(name, reason)])``.

    Names are bare file (or Spark folder) names including the extension, the
    key used by maps. With a map, CSV columns are read as text under their exact names: standardizing
    casts them to the declared types, so a declared String keeps its zeros and
    a bad cell costs only itself, and no pass infers types. Without one (profiles), types are inferred, blanks around
    header names are stripped, and ``na_tokens`` (the usual spellings of missing values unless given) read as null.
    Unreadable or unsupported entries are reported, not
    fatal, unless ``strict``.
    """
    from canonix.session import basename, hadoop_list

    profile = hmap is None
    tokens = (PANDAS_NA_TOKENS if profile else ()) if na_tokens is None else na_tokens
    out: dict[str, DataFrame] = {}
    skipped: list[tuple[str, str]] = []
    for path, _is_file in sorted(hadoop_list(spark, folder)):
        name = basename(path)
        if name.startswith((".", "_")):
            continue
        ext = extension_of(name)
        if ext not in TABULAR_EXTENSIONS:
            skipped.append((name, f"unsupported extension {ext or '(none)'}"))
            continue
        try:
            df = read_dataset(spark, path, infer=profile, na_tokens=tokens, multi_line=multi_line)
            _ = df.schema  # resolve now so an unreadable file is reported here
            out[name] = trim_headers(df) if profile else _as_mapped(df, name, hmap)
        except Exception as e:  # noqa: BLE001
            if strict:
                raise
            skipped.append((name, f"unreadable: {e}" if isinstance(e, ValueError) else f"unreadable: {type(e).__name__}"))
    return out, skipped


def _as_mapped(df: DataFrame, dataset: str, hmap: HarmonizationMap) -> DataFrame:
    """Columns under their exact names, but without the blanks around them where only that name is in the map."""
    listed = {c for f in hmap.features for c in f.candidates(dataset)}
    names = [c.strip() if c not in listed and c.strip() in listed and c.strip() not in df.columns else c for c in df.columns]
    return df if names == df.columns or len(set(names)) < len(names) else df.toDF(*names)


def skipped_frame(spark: SparkSession, skipped: Sequence[tuple[str, str]]) -> DataFrame:
    """The ``(dataset, reason)`` skip list of :func:`load_folder` as a DataFrame (one row per folder entry)."""
    return spark.createDataFrame(list(skipped), "dataset string, reason string")
