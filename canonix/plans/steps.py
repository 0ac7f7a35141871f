"""Declarative step lists.

A spec is a JSON list of ``{function, args, output_variable}``. Arguments that
are placeholders (``_name_``) are resolved from the environment:
``_harmonization_map_``, ``_data_folder_path_``, ``_current_df_``,
``_all_datasets_`` and ``_<output_variable>_`` of an earlier step. An unknown
placeholder raises. Function names come from a closed registry (the
reference's names are accepted as aliases). Every step is lazy: the plan runs
once, at the sink.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from canonix.model import HarmonizationMap
from canonix.operators.filters import filter_by_value
from canonix.operators.merge import merge_by_key
from canonix.operators.standardize import standardize
from canonix.operators.values import unique_values_across, unique_values_df, unique_values_single


@dataclass
class StepEnv:
    spark: SparkSession
    hmap: HarmonizationMap
    datasets: Mapping[str, DataFrame]
    folder: str | None = None
    variables: dict[str, Any] = field(default_factory=dict)
    current: Any = None


def _datasets_arg(env: StepEnv, v: Any) -> Mapping[str, DataFrame]:
    # a folder path placeholder resolves to the already-loaded datasets of that folder
    if v is None or isinstance(v, str):
        return env.datasets
    return v


def _std(env: StepEnv, df: DataFrame, filename: str, harmonization_map=None) -> DataFrame:
    return standardize(df, filename, harmonization_map or env.hmap)


def _unique_across(env: StepEnv, canonical_feature_name: str, harmonization_map=None, data_folder_path=None):
    return unique_values_across(harmonization_map or env.hmap, _datasets_arg(env, data_folder_path),
                                canonical_feature_name, spark=env.spark)


def _merge(env: StepEnv, merge_key_canonical_name: str, harmonization_map=None, data_folder_path=None,
           order=None, strategy: str = "auto"):
    return merge_by_key(harmonization_map or env.hmap, _datasets_arg(env, data_folder_path),
                        merge_key_canonical_name, order=order, strategy=strategy)


def _filter(env: StepEnv, df: DataFrame, canonical_feature_name: str, value: str, scope: str = "first"):
    return filter_by_value(df, canonical_feature_name, str(value), scope=scope)


def _unique_df(env: StepEnv, df: DataFrame, canonical_feature_name: str):
    return unique_values_df(df, canonical_feature_name)


def _unique_single(env: StepEnv, file_path: str, canonical_feature_name: str, harmonization_map=None):
    name = file_path.rstrip("/").rsplit("/", 1)[-1]
    return unique_values_single(env.datasets[name], name, harmonization_map or env.hmap, canonical_feature_name)


REGISTRY: dict[str, Callable[..., Any]] = {
    "standardize": _std,
    "unique_values_across": _unique_across,
    "merge": _merge,
    "filter": _filter,
    "unique_values_df": _unique_df,
    "unique_values_single": _unique_single,
}

# Public step names (fixed values).
ALIASES = {
    "standardize_dataframe_columns": "standardize",
    "get_unique_values_for_canonical_feature": "unique_values_across",
    "merge_datasets_by_canonical_key": "merge",
    "filter_dataframe_by_canonical_value": "filter",
    "get_unique_values_from_df": "unique_values_df",
    "get_unique_values_from_single_file": "unique_values_single",
}


def _resolve(env: StepEnv, value: Any) -> Any:
    if not (isinstance(value, str) and len(value) > 2 and value.startswith("_") and value.endswith("_")):
        return value
    if value == "_harmonization_map_":
        return env.hmap
    if value == "_data_folder_path_":
        return env.folder
    if value == "_current_df_":
        return env.current
    if value == "_all_datasets_":
        return env.datasets
    name = value[1:-1]
    if name in env.variables:
        return env.variables[name]
    raise KeyError(f"unresolved placeholder {value!r}")


def run_steps(spec: str | list[dict], env: StepEnv) -> Any:
    """Run a step list; returns the last step's output (a lazy DataFrame)."""
    steps = json.loads(spec) if isinstance(spec, str) else spec
    result = None
    for i, step in enumerate(steps):
        fname = step.get("function")
        fname = ALIASES.get(fname, fname)
        if fname not in REGISTRY:
            raise KeyError(f"step {i + 1}: unknown function {step.get('function')!r}")
        args = {k: _resolve(env, v) for k, v in (step.get("args") or {}).items()}
        result = REGISTRY[fname](env, **args)
        out = step.get("output_variable")
        if out:
            env.variables[out] = result
        env.current = result
    return result
