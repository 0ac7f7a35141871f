"""The place of every row in a sorted table, without a window over all rows.

The sorted rows are written to the shared folder: files in order of their names, rows in file order.
A window runs over the table of files only (one row a file); a row's place is the rows of the files
before its own plus its index there. A lost task reads files again, so places stay the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canonix.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again."""
    out = scratch_path(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def with_files(rows: DataFrame) -> DataFrame:
    """Rows of a written table with ``__file`` and ``__index`` (place in the file)."""
    meta = rows.metadataColumn("_metadata")
    return rows.withColumns({"__file": meta["file_path"], "__index": meta["row_index"]})


def rows_before(order: str = "__file", rows: str = "n", within: list[str] | None = None):
    """Sum of ``rows`` over what comes before in ``order``."""
    window = Window.partitionBy(*(within or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(rows).over(window), F.lit(0)).cast("long")


def placed(df: DataFrame, name: str = "place") -> DataFrame:
    """The rows of ``df``, which is sorted as a whole, with their place from 0."""
    rows = with_files(written(df, "placed"))
    files = rows.groupBy("__file").agg(F.count("*").alias("n"))
    files = written(files.select("__file", rows_before().alias("__before")), "placed-files")
    return rows.join(files, "__file").withColumn(name, F.col("__before") + F.col("__index")).drop("__file", "__index", "__before")
