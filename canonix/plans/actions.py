"""Action dispatch (W4): the three manipulation actions with their required arguments.

``unique_values`` needs a feature; ``merge`` needs the merge key; ``filter``
needs a feature and a value and merges on the map's first feature unless a key
is given. Missing arguments raise instead of printing and returning nothing.
Every action returns a lazy DataFrame; writing it is the caller's choice of sink.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from canonix.model import HarmonizationMap
from canonix.operators.filters import merge_then_filter
from canonix.operators.merge import merge_by_key
from canonix.operators.values import unique_values_across

ACTIONS = ("unique_values", "merge", "filter")


def run_action(
    action: str,
    hmap: HarmonizationMap,
    datasets: Mapping[str, DataFrame],
    canonical_feature: str | None = None,
    filter_value: str | None = None,
    key: str | None = None,
    **kwargs,
) -> DataFrame:
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
    if action == "unique_values":
        if not canonical_feature:
            raise ValueError("unique_values requires canonical_feature")
        return unique_values_across(hmap, datasets, canonical_feature)
    if action == "merge":
        if not canonical_feature:
            raise ValueError("merge requires canonical_feature (the merge key)")
        return merge_by_key(hmap, datasets, canonical_feature, **kwargs)
    if not canonical_feature or filter_value is None:
        raise ValueError("filter requires canonical_feature and filter_value")
    if not hmap.features:
        raise ValueError("filter needs a map with at least one feature to merge on")
    return merge_then_filter(hmap, datasets, canonical_feature, str(filter_value), key=key, **kwargs)
