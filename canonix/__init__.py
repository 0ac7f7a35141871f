"""canonix: Spark-native harmonization of many tables under one canonical schema."""

import sys as _sys


def _ship_by_value(module) -> None:
    """Let Python workers run this package's functions without it being installed there.

    Functions of a registered module are pickled by value into the task, so
    ``mapInPandas`` / pandas UDF helpers work on executors whose Python path
    does not contain the package (as with ``--py-files`` but without a file).
    """
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(module)
    except Exception:  # older cloudpickle: fall back to shipping the package with --py-files
        pass


_ship_by_value(_sys.modules[__name__])

from canonix.model import HarmonizationMap, load_map, load_map_long, testdata_map
from canonix.operators.filters import filter_by_value, merge_then_filter
from canonix.operators.merge import SkewConfig, merge_by_key
from canonix.operators.standardize import standardize, standardize_all, trim_headers
from canonix.operators.values import unique_values_across, unique_values_df, unique_values_single

__all__ = [
    "HarmonizationMap",
    "SkewConfig",
    "filter_by_value",
    "load_map",
    "load_map_long",
    "merge_by_key",
    "merge_then_filter",
    "standardize",
    "standardize_all",
    "testdata_map",
    "trim_headers",
    "unique_values_across",
    "unique_values_df",
    "unique_values_single",
]
