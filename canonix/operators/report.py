"""Harmonization report (W2), feature context lines (C13) and map output (K3).

The report joins the long map with the column profile, then nests it back into
the v2 document shape: per feature the mapped columns with their physical type
and null count, per dataset its shape. Everything stays a DataFrame; the map
file is written by Spark's JSON writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def vocabulary_type(spark_type: Column) -> Column:
    """Integer, Float or String, the types of the document, for a Spark type's name (others are String)."""
    return F.when(spark_type.isin("tinyint", "smallint", "int", "bigint", "Integer"), "Integer").when(
        spark_type.isin("float", "double", "Float") | spark_type.startswith("decimal"), "Float").when(spark_type.isNotNull(), "String")


def report_long(map_long: DataFrame, column_profile: DataFrame) -> DataFrame:
    """Long map rows enriched with the profiled type and null count of each column."""
    prof = column_profile.select(
        "dataset", "column_name",
        F.col("data_type").alias("profiled_type"),
        F.col("null_count").alias("profiled_nulls"),
    )
    joined = map_long.join(prof, ["dataset", "column_name"], "left")
    return joined.select(
        "feature_pos", "canonical_name", "semantic_meaning", "data_type", "dataset", "cand_pos", "column_name",
        vocabulary_type(F.coalesce("profiled_type", "column_type")).alias("column_type"),
        F.coalesce("profiled_nulls", "nan_count").alias("nan_count"),
    )


def harmonization_report(map_long: DataFrame, column_profile: DataFrame, dataset_profile: DataFrame) -> DataFrame:
    """One-row v2 report: ``harmonization_details`` array and ``dataset_info`` map."""
    rl = report_long(map_long, column_profile)
    per_ds = rl.groupBy("feature_pos", "canonical_name", "semantic_meaning", "data_type", "dataset").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(
                "cand_pos",
                F.struct("column_name", F.col("column_type").alias("data_type"), "nan_count").alias("c"),
            ))),
            lambda s: s["c"],
        ).alias("cols")
    )
    per_feature = per_ds.groupBy("feature_pos", "canonical_name", "semantic_meaning", "data_type").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("dataset", "cols")))).alias("original_columns")
    )
    by_pos = lambda a, b: (a["feature_pos"] - b["feature_pos"]).cast("int")  # noqa: E731 (maps are not orderable)
    details = per_feature.groupBy(F.lit(1).alias("__one")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(
                "feature_pos",
                F.struct("canonical_name", "semantic_meaning", "data_type", "original_columns").alias("f"),
            )), by_pos),
            lambda s: s["f"],
        ).alias("harmonization_details")
    )
    mapped = rl.select("dataset").distinct()
    info = dataset_profile.join(mapped, "dataset").groupBy(F.lit(1).alias("__one")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            "dataset", F.struct(F.array(F.col("rows").cast("bigint"), F.col("cols").cast("bigint")).alias("shape"))
        )))).alias("dataset_info")
    )
    # Both sides are single-row aggregates, joined on a constant key.
    return details.join(info, "__one", "left").drop("__one")


def feature_context(report: DataFrame) -> DataFrame:
    """Text lines describing features and datasets (C13): ``(section, ord, line)``.

    ``- name: meaning (Type: t)`` per feature, ``- dataset: Shape [r, c]`` per
    dataset (``N/A`` when the shape is unknown).
    """
    feats = report.select(F.posexplode("harmonization_details").alias("ord", "f")).select(
        F.lit("features").alias("section"),
        "ord",
        F.format_string("- %s: %s (Type: %s)", F.col("f.canonical_name"),
                        F.coalesce(F.col("f.semantic_meaning"), F.lit("None")),
                        F.coalesce(F.col("f.data_type"), F.lit("None"))).alias("line"),
    )
    ds = report.select(F.explode("dataset_info").alias("dataset", "info")).select(
        F.lit("datasets").alias("section"),
        F.col("dataset"),
        F.format_string(
            "- %s: Shape %s", F.col("dataset"),
            F.coalesce(F.concat(F.lit("["), F.array_join(F.col("info.shape").cast("array<string>"), ", "), F.lit("]")),
                       F.lit("N/A")),
        ).alias("line"),
    )
    ds = ds.withColumn("ord", F.row_number().over(Window.orderBy("dataset")) - 1)  # one row per dataset
    return feats.unionByName(ds.select("section", "ord", "line"))


def write_map_json(report: DataFrame, path: str) -> None:
    """Write the report as one JSON document (K3). The report is a single row."""
    report.coalesce(1).write.mode("errorifexists").json(path)
