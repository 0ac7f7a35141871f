"""Sinks (K1, K2, K4). Every operator returns a DataFrame; any of them can be
written by these, one task per partition (no single-task funnel)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonix.model import quote


def write_text(values: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-column value list as text, one value per line (K1)."""
    if len(values.columns) != 1:
        raise ValueError("write_text takes a single-column DataFrame")
    c = values.columns[0]
    values.select(F.col(quote(c)).cast("string").alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table as CSV with a header row (K2); a quote inside a cell is doubled, as standard readers expect, and blanks around it stay."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """First ``n`` rows (in an explicit order when given) and the ``(rows, cols)`` shape (K4)."""
    rows = df.orderBy(*[F.col(quote(c)) for c in order_by]).limit(n) if order_by else df.limit(n)
    shape = df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).alias("cols"))
    return rows, shape
