"""Folder listings as DataFrames.

Listing goes through Spark's file index (``binaryFile`` with the content
column pruned), so a folder of millions of files is listed by the cluster, not
by a driver loop. A dataset is a top-level entry of the folder: a file, or a
folder written by Spark (``orders.csv/part-*.csv``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.functions.text import base_name, ends_with_any, extension, file_name
from canonix.sources.tables import TABULAR_EXTENSIONS

# Sidecar metadata extensions, in precedence order (first wins).
METADATA_EXTENSIONS = (".json", ".txt", ".yaml", ".yml", ".md")


def _norm(folder: str) -> str:
    return folder.rstrip("/")


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """All files under ``folder`` (recursive): ``(path, length, modificationTime)``; content never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folder).select("path", "length", "modificationTime")


def _relative(path: Column, folder: str) -> Column:
    """Path relative to ``folder`` (works for ``file:`` and other schemes)."""
    tail = "/" + _norm(folder).split(":", 1)[-1].lstrip("/")
    return F.substring_index(path, tail + "/", -1)


def folder_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One row per top-level entry: ``(dataset, extension, kind, files, bytes, modified)``.

    ``kind`` is ``tabular`` (``.csv .parquet .xlsx``, any letter case),
    ``metadata`` (``.json .txt .yaml .yml .md``) or ``other``.
    """
    files = list_files(spark, folder)
    rel = _relative(F.col("path"), folder)
    entry = F.substring_index(rel, "/", 1)
    inv = files.select(entry.alias("dataset"), "length", "modificationTime").groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("modified"),
    )
    ext = F.lower(extension(F.col("dataset")))
    kind = (
        F.when(ext.isin(*TABULAR_EXTENSIONS), F.lit("tabular"))
        .when(ext.isin(*METADATA_EXTENSIONS), F.lit("metadata"))
        .otherwise(F.lit("other"))
    )
    return inv.select("dataset", ext.alias("extension"), kind.alias("kind"), "files", "bytes", "modified")


def recursive_discovery(spark: SparkSession, folder: str, extensions: Sequence[str],
                        ignore_case: bool = False) -> DataFrame:
    """Files under ``folder`` at any depth whose name ends with one of ``extensions``.

    Case-sensitive by default, as a plain suffix test is.
    """
    files = list_files(spark, folder)
    name = file_name(F.col("path"))
    return files.where(ends_with_any(name, extensions, ignore_case)).select(
        "path", _relative(F.col("path"), folder).alias("relative_path"), name.alias("file_name"), "length")


def sidecar_pairing(spark: SparkSession, folder: str, datasets: DataFrame | None = None) -> DataFrame:
    """Metadata text for each tabular dataset (S5): ``(dataset, metadata_file, metadata_text)``.

    A sidecar is a top-level file with the dataset's base name and one of the
    metadata extensions; the first extension in precedence order wins.
    """
    from canonix.session import hadoop_list

    inv = datasets if datasets is not None else folder_inventory(spark, folder).where(F.col("kind") == "tabular")
    # Only top-level files can be sidecars: take their names from one listing of
    # the folder, so text files nested inside dataset folders are never read.
    paths = [p for p, is_file in hadoop_list(spark, folder)
             if is_file and any(p.endswith(e) for e in METADATA_EXTENSIONS)]
    tab = inv.select("dataset", base_name(F.col("dataset")).alias("base"))
    if not paths:
        return tab.select("dataset", F.lit(None).cast("string").alias("metadata_file"),
                          F.lit(None).cast("string").alias("metadata_text"))
    texts = spark.read.text(paths, wholetext=True).select(
        F.col("value").alias("metadata_text"), F.col("_metadata.file_name").alias("path"))
    # the file name, too, comes percent-encoded; a plus sign stands for itself
    texts = texts.withColumn("path", F.coalesce(
        F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "path"))
    rank = F.array_position(F.array(*[F.lit(e) for e in METADATA_EXTENSIONS]), extension(F.col("path")))
    texts = texts.select(
        base_name(F.col("path")).alias("base"),
        file_name(F.col("path")).alias("metadata_file"),
        rank.alias("rank"),
        "metadata_text",
    ).where(F.col("rank") > 0)
    best = texts.groupBy("base").agg(
        F.min_by(F.struct("metadata_file", "metadata_text"), F.col("rank")).alias("m"))
    return tab.join(best, "base", "left").select(
        "dataset", F.col("m.metadata_file").alias("metadata_file"), F.col("m.metadata_text").alias("metadata_text"))
