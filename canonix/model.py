"""Harmonization map model.

A map groups original columns of many datasets into canonical features. Two
document shapes exist:

* v1 (list form): ``[{canonical_name, semantic_meaning, data_type,
  original_columns: {dataset: [column, ...]}}]``
* v2 (object form): ``{harmonization_details: [... original_columns:
  {dataset: [{column_name, data_type, nan_count}]}], dataset_info:
  {dataset: {shape: [rows, cols]}}}``

The map is schema-level metadata (its size follows the number of columns, not
rows), so the driver holds it as a Python object to build projections. The same
document can also be read as a long Spark table (one row per candidate column)
for joins against profiles.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MapLoadError(ValueError):
    """Raised when a map document is missing or not valid JSON of either version."""


# Declared vocabulary of map data types -> Spark types.
DECLARED_TYPES: dict[str, T.DataType] = {
    "Integer": T.LongType(),
    "String": T.StringType(),
    "Float": T.DoubleType(),
}

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_basic_type(dt: T.DataType) -> bool:
    """Types the declared vocabulary can cast between (numbers, strings, booleans)."""
    return isinstance(dt, _NUMERIC + (T.StringType, T.BooleanType))


def quote(name: str) -> str:
    """Backtick-quote a column name (spaces, dots, backticks)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def declared_type(name: str | None) -> T.DataType:
    if name is None:
        return T.StringType()
    return DECLARED_TYPES.get(name, T.StringType())


@dataclass(frozen=True)
class ColumnRef:
    column_name: str
    data_type: str | None = None
    nan_count: int | None = None


@dataclass
class Feature:
    canonical_name: str
    semantic_meaning: str | None = None
    data_type: str | None = None
    original_columns: dict[str, list[ColumnRef]] = field(default_factory=dict)

    def candidates(self, dataset: str) -> list[str]:
        return [c.column_name for c in self.original_columns.get(dataset, [])]


@dataclass
class HarmonizationMap:
    features: list[Feature]
    dataset_info: dict[str, list[int] | None] = field(default_factory=dict)
    version: int = 1

    # ---- construction -------------------------------------------------
    @staticmethod
    def from_obj(obj: Any) -> "HarmonizationMap":
        if isinstance(obj, list):
            return HarmonizationMap([_feature(f) for f in obj], {}, 1)
        if isinstance(obj, dict) and "harmonization_details" in obj:
            info = {}
            for ds, meta in (obj.get("dataset_info") or {}).items():
                shape = meta.get("shape") if isinstance(meta, dict) else None
                info[ds] = list(shape) if shape is not None else None
            return HarmonizationMap([_feature(f) for f in obj.get("harmonization_details") or []], info, 2)
        raise MapLoadError("map document is neither a v1 list nor a v2 object with harmonization_details")

    @staticmethod
    def from_json(text: str) -> "HarmonizationMap":
        try:
            obj = json.loads(text)
        except json.JSONDecodeError as e:  # noqa: PERF203
            raise MapLoadError(f"map is not valid JSON: {e}") from e
        return HarmonizationMap.from_obj(obj)

    # ---- queries --------------------------------------------------------
    @property
    def feature_names(self) -> list[str]:
        return [f.canonical_name for f in self.features]

    def feature(self, name: str) -> Feature | None:
        for f in self.features:
            if f.canonical_name == name:
                return f
        return None

    def datasets(self) -> list[str]:
        """Datasets named anywhere in the map, in first-mention order."""
        seen: dict[str, None] = {}
        for f in self.features:
            for ds in f.original_columns:
                seen.setdefault(ds, None)
        return list(seen)

    def maps_feature(self, dataset: str, feature: str) -> bool:
        f = self.feature(feature)
        return f is not None and bool(f.candidates(dataset))

    # ---- serialization -------------------------------------------------
    def to_v1(self) -> list[dict]:
        return [
            {
                "canonical_name": f.canonical_name,
                "semantic_meaning": f.semantic_meaning,
                "data_type": f.data_type,
                "original_columns": {ds: [c.column_name for c in refs] for ds, refs in f.original_columns.items()},
            }
            for f in self.features
        ]

    def to_v2(self) -> dict:
        return {
            "harmonization_details": [
                {
                    "canonical_name": f.canonical_name,
                    "semantic_meaning": f.semantic_meaning,
                    "data_type": f.data_type,
                    "original_columns": {
                        ds: [
                            {"column_name": c.column_name, "data_type": c.data_type, "nan_count": c.nan_count}
                            for c in refs
                        ]
                        for ds, refs in f.original_columns.items()
                    },
                }
                for f in self.features
            ],
            "dataset_info": {ds: {"shape": shape} for ds, shape in self.dataset_info.items()},
        }

    def long_rows(self) -> list[tuple]:
        rows = []
        for fpos, f in enumerate(self.features):
            for ds, refs in f.original_columns.items():
                for cpos, c in enumerate(refs):
                    rows.append(
                        (fpos, f.canonical_name, f.semantic_meaning, f.data_type, ds, cpos, c.column_name,
                         c.data_type, c.nan_count)
                    )
        return rows

    def to_long_df(self, spark: SparkSession) -> DataFrame:
        """The map as a long table (one row per candidate column)."""
        return spark.createDataFrame(self.long_rows(), schema=LONG_SCHEMA)


LONG_SCHEMA = T.StructType(
    [
        T.StructField("feature_pos", T.IntegerType()),
        T.StructField("canonical_name", T.StringType()),
        T.StructField("semantic_meaning", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("cand_pos", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("nan_count", T.LongType()),
    ]
)


def _feature(obj: dict) -> Feature:
    if not isinstance(obj, dict) or "canonical_name" not in obj:
        raise MapLoadError(f"feature entry without canonical_name: {obj!r}")
    oc: dict[str, list[ColumnRef]] = {}
    for ds, cols in (obj.get("original_columns") or {}).items():
        refs = []
        for c in cols or []:
            if isinstance(c, str):
                refs.append(ColumnRef(c))
            elif isinstance(c, dict) and "column_name" in c:
                # v2 entry: normalize to its column_name (never the object's text)
                nc = c.get("nan_count")
                refs.append(ColumnRef(c["column_name"], c.get("data_type"), int(nc) if nc is not None else None))
            else:
                raise MapLoadError(f"unrecognized column entry {c!r} for dataset {ds!r}")
        oc[ds] = refs
    return Feature(obj["canonical_name"], obj.get("semantic_meaning"), obj.get("data_type"), oc)


# ---------------------------------------------------------------------------
# Loading through Spark (works on any shared filesystem the session can read)
# ---------------------------------------------------------------------------

def read_map_text(spark: SparkSession, path: str) -> str:
    """Read a map document's text. The document is a bounded metadata file."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(2).collect()  # one small document
    except Exception as e:  # AnalysisException for a missing path
        raise MapLoadError(f"map not found at {path}: {e}") from e
    if not rows:
        raise MapLoadError(f"map at {path} is empty")
    if len(rows) > 1:
        raise MapLoadError(f"{path} holds more than one document; pass the map file itself")
    return rows[0][0]


def load_map(spark: SparkSession, path: str) -> HarmonizationMap:
    """Load a v1 or v2 map into the driver-side model (raises MapLoadError)."""
    return HarmonizationMap.from_json(read_map_text(spark, path))


_V1_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("canonical_name", T.StringType()),
            T.StructField("semantic_meaning", T.StringType()),
            T.StructField("data_type", T.StringType()),
            T.StructField("original_columns", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        ]
    )
)

_V2_COL = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("nan_count", T.LongType()),
    ]
)

_V2_SCHEMA = T.StructType(
    [
        T.StructField(
            "harmonization_details",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("canonical_name", T.StringType()),
                        T.StructField("semantic_meaning", T.StringType()),
                        T.StructField("data_type", T.StringType()),
                        T.StructField("original_columns", T.MapType(T.StringType(), T.ArrayType(_V2_COL))),
                    ]
                )
            ),
        ),
        T.StructField(
            "dataset_info",
            T.MapType(T.StringType(), T.StructType([T.StructField("shape", T.ArrayType(T.LongType()))])),
        ),
    ]
)


def map_long_from_text(text_df: DataFrame, value_col: str = "value") -> DataFrame:
    """Normalize map documents held in a string column into the long table.

    The version is detected from the first non-blank character *before* parsing:
    parsing a v2 document with the v1 schema does not fail, it stores each
    column object's JSON text as a column name.
    """
    v = F.ltrim(F.col(value_col))
    is_v1 = F.startswith(v, F.lit("["))
    feats_v1 = F.from_json(F.col(value_col), _V1_SCHEMA)
    feats_v2 = F.from_json(F.col(value_col), _V2_SCHEMA).getField("harmonization_details")
    as_common_v1 = F.transform(
        feats_v1,
        lambda f: F.struct(
            f["canonical_name"].alias("canonical_name"),
            f["semantic_meaning"].alias("semantic_meaning"),
            f["data_type"].alias("data_type"),
            F.transform_values(
                f["original_columns"],
                lambda _k, arr: F.transform(
                    arr,
                    lambda c: F.struct(
                        c.alias("column_name"),
                        F.lit(None).cast("string").alias("data_type"),
                        F.lit(None).cast("bigint").alias("nan_count"),
                    ),
                ),
            ).alias("original_columns"),
        ),
    )
    feats = F.when(is_v1, as_common_v1).otherwise(feats_v2)
    df = text_df.select(F.posexplode(feats).alias("feature_pos", "f"))
    df = df.select(
        "feature_pos",
        F.col("f.canonical_name").alias("canonical_name"),
        F.col("f.semantic_meaning").alias("semantic_meaning"),
        F.col("f.data_type").alias("data_type"),
        F.explode(F.col("f.original_columns")).alias("dataset", "cols"),
    )
    df = df.select(
        "feature_pos", "canonical_name", "semantic_meaning", "data_type", "dataset",
        F.posexplode("cols").alias("cand_pos", "c"),
    )
    return df.select(
        F.col("feature_pos").cast("int").alias("feature_pos"),
        "canonical_name",
        "semantic_meaning",
        "data_type",
        "dataset",
        F.col("cand_pos").cast("int").alias("cand_pos"),
        F.col("c.column_name").alias("column_name"),
        F.col("c.data_type").alias("column_type"),
        F.col("c.nan_count").alias("nan_count"),
    )


def load_map_long(spark: SparkSession, path: str) -> DataFrame:
    """Spark-side reader: one map file (or a folder of them) to the long table."""
    return map_long_from_text(spark.read.text(path, wholetext=True))


# ---------------------------------------------------------------------------
# Fixture map M-T over /root/testdata (dataset name = "<table>.parquet").
# The feature list of the test fixture, in map order.
# ---------------------------------------------------------------------------

TESTDATA_MAP_V1: list[dict] = [
    {"canonical_name": "nation_key", "semantic_meaning": "Key of a nation.", "data_type": "Integer",
     "original_columns": {"customer.parquet": ["c_nationkey"], "supplier.parquet": ["s_nationkey"],
                          "nation.parquet": ["n_nationkey"]}},
    {"canonical_name": "party_key", "semantic_meaning": "Key of a customer or supplier.", "data_type": "Integer",
     "original_columns": {"customer.parquet": ["c_custkey"], "supplier.parquet": ["s_suppkey"],
                          "orders.parquet": ["o_custkey"]}},
    {"canonical_name": "party_name", "semantic_meaning": "Name of a customer or supplier.", "data_type": "String",
     "original_columns": {"customer.parquet": ["c_name"], "supplier.parquet": ["s_name"]}},
    {"canonical_name": "account_balance", "semantic_meaning": "Account balance.", "data_type": "Float",
     "original_columns": {"customer.parquet": ["c_acctbal"], "supplier.parquet": ["s_acctbal"]}},
    {"canonical_name": "nation_name", "semantic_meaning": "Name of a nation.", "data_type": "String",
     "original_columns": {"nation.parquet": ["n_name"]}},
    {"canonical_name": "region_key", "semantic_meaning": "Key of a region.", "data_type": "Integer",
     "original_columns": {"nation.parquet": ["n_regionkey"], "region.parquet": ["r_regionkey"]}},
    {"canonical_name": "region_name", "semantic_meaning": "Name of a region.", "data_type": "String",
     "original_columns": {"region.parquet": ["r_name"]}},
    {"canonical_name": "order_key", "semantic_meaning": "Key of an order.", "data_type": "Integer",
     "original_columns": {"orders.parquet": ["o_orderkey"], "lineitem.parquet": ["l_orderkey"]}},
    {"canonical_name": "status", "semantic_meaning": "Status flag.", "data_type": "String",
     "original_columns": {"orders.parquet": ["o_orderstatus"], "lineitem.parquet": ["l_linestatus"]}},
    {"canonical_name": "amount", "semantic_meaning": "Monetary amount.", "data_type": "Float",
     "original_columns": {"orders.parquet": ["o_totalprice"], "lineitem.parquet": ["l_extendedprice"]}},
    {"canonical_name": "event_date", "semantic_meaning": "Date of the event.", "data_type": "String",
     "original_columns": {"orders.parquet": ["o_orderdate"], "lineitem.parquet": ["l_shipdate"]}},
    {"canonical_name": "part_key", "semantic_meaning": "Key of a part.", "data_type": "Integer",
     "original_columns": {"lineitem.parquet": ["l_partkey"], "part.parquet": ["p_partkey"]}},
]


def testdata_map() -> HarmonizationMap:
    return HarmonizationMap.from_obj(TESTDATA_MAP_V1)


testdata_map.__test__ = False  # not a pytest test despite its name
