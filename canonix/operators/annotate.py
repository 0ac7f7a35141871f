"""Row annotation with an ordered provider fallback.

``providers`` is a list of ``(name, fn)``; ``fn`` takes a pandas Series of
input values and returns a Series of results (``None`` = no answer). For each
row the first provider that answers wins and is recorded; a provider that
raises is recorded as the error for the rows still open. Runs in
``mapInPandas`` (Arrow batches); no client ships with the library.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Provider = tuple[str, Callable[[pd.Series], pd.Series]]


def annotate(df: DataFrame, column: str, providers: Sequence[Provider]) -> DataFrame:
    """``df`` plus ``(result, provider, error)`` per row."""
    provs = list(providers)
    out_schema = T.StructType(
        list(df.schema.fields)
        + [T.StructField("result", T.StringType()), T.StructField("provider", T.StringType()),
           T.StructField("error", T.StringType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            result = pd.Series([None] * n, dtype=object)
            provider = pd.Series([None] * n, dtype=object)
            error = pd.Series([None] * n, dtype=object)
            open_ = pd.Series([True] * n)
            for name, fn in provs:
                if not open_.any():
                    break
                idx = open_[open_].index
                try:
                    got = pd.Series(list(fn(pdf[column].iloc[idx].reset_index(drop=True))), index=idx, dtype=object)
                except Exception as e:  # noqa: BLE001 - a failing provider falls through to the next
                    error.loc[idx] = f"{name}: {type(e).__name__}: {e}"
                    continue
                ok = got.notna()
                hit = got[ok].index
                result.loc[hit] = got[ok].astype(str)
                provider.loc[hit] = name
                error.loc[hit] = None
                open_.loc[hit] = False
            yield pdf.assign(result=result.values, provider=provider.values, error=error.values)

    return df.mapInPandas(run, out_schema)
