"""Folder-level workflows.

``analyze``: profile every dataset, match columns, assemble the report; samples and sidecar text are kept in the profiles.
``ensure_map``: load the map at a path, or build it with ``harmonize`` and
write it there first (the reference's auto-generate path, with a deterministic
matcher in place of the model call).
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.model import HarmonizationMap, MapLoadError, load_map
from canonix.operators.match import MatchConfig, match_columns
from canonix.operators.profile import dataset_profile
from canonix.operators.report import harmonization_report


class Analysis(NamedTuple):
    """What W6 finds: the report, profiles with samples and metadata text, and the matched columns."""

    report: DataFrame
    column_profile: DataFrame
    map_long: DataFrame
    dataset_profile: DataFrame


def analyze(datasets: Mapping[str, DataFrame], metadata: DataFrame | None = None,
            cfg: MatchConfig | None = None, heads: Mapping[str, DataFrame] | None = None) -> Analysis:
    """Profile, match and report a set of datasets."""
    col_prof, ds_prof = dataset_profile(datasets, metadata=metadata, heads=heads)
    map_long = match_columns(datasets, cfg)
    report = harmonization_report(map_long, col_prof, ds_prof)
    return Analysis(report, col_prof, map_long, ds_prof)


def harmonize(datasets: Mapping[str, DataFrame], metadata: DataFrame | None = None,
              cfg: MatchConfig | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(report, column_profile, map_long)`` of :func:`analyze`."""
    return analyze(datasets, metadata, cfg)[:3]


def harmonize_folder(spark: SparkSession, folder: str, cfg: MatchConfig | None = None
                     ) -> tuple[DataFrame, DataFrame, DataFrame, list[tuple[str, str]]]:
    """``(report, column_profile, map_long, skipped)`` of :func:`analyze_folder`."""
    found, skipped = analyze_folder(spark, folder, cfg)
    return *found[:3], skipped


def analyze_folder(spark: SparkSession, folder: str, cfg: MatchConfig | None = None
                   ) -> tuple[Analysis, list[tuple[str, str]]]:
    """W6 end to end: load every tabular dataset of a folder, pair sidecar metadata,
    profile, match and report. Returns the analysis and the entries skipped."""
    from canonix.sources.listing import sidecar_pairing
    from canonix.sources.tables import PANDAS_NA_TOKENS, load_folder, read_head

    datasets, skipped = load_folder(spark, folder)
    if not datasets:
        raise ValueError(f"no readable tabular dataset under {folder}")
    heads = {name: read_head(spark, f"{folder.rstrip('/')}/{name}", df, na_tokens=PANDAS_NA_TOKENS) for name, df in datasets.items()}
    return analyze(datasets, sidecar_pairing(spark, folder), cfg, {n: h for n, h in heads.items() if h is not None}), skipped


def ensure_map(spark: SparkSession, datasets: Mapping[str, DataFrame], map_path: str,
               cfg: MatchConfig | None = None, replace_invalid: bool = False) -> HarmonizationMap:
    """Load the map, generating and writing it (v2 document) when it does not exist.

    A file there that is no map raises ``MapLoadError``; with ``replace_invalid`` it is replaced by a new map.
    """
    from canonix.session import hadoop_exists

    there = hadoop_exists(spark, map_path)
    if there:
        try:
            return load_map(spark, map_path)
        except MapLoadError as e:
            if not replace_invalid:
                raise MapLoadError(f"{map_path} is there but holds no valid map ({e}); replace_invalid=True generates a new one in its place") from e
    report = analyze(datasets, cfg=cfg).report
    # one row: the map document
    report.coalesce(1).write.mode("overwrite" if there else "errorifexists").json(map_path)
    return load_map_from_report_folder(spark, map_path)


def load_map_from_report_folder(spark: SparkSession, path: str) -> HarmonizationMap:
    """A map written by Spark's JSON writer (a folder with one part file)."""
    text = spark.read.text(path, wholetext=True).where(F.length("value") > 0).collect()
    if not text:
        raise MapLoadError(f"no map document under {path}")
    return HarmonizationMap.from_json(text[0][0])
