"""

Datasets are the parquet tables of an ``sf`` folder, named ``<table>.parquet``
as map keys; the map is the test fixture map M-T (``canonix.model``).
Queries that exercise file sources and sinks first write data derived from the
given tables to a fresh folder under the session's checkpoint directory.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonix.functions import jsontext, text
from canonix.model import HarmonizationMap, TESTDATA_MAP_V1, load_map_long, testdata_map
from canonix.operators import annotate as ann
from canonix.operators import match as mt
from canonix.operators import profile as pf
from canonix.operators import report as rp
from canonix.operators.filters import filter_by_value, merge_then_filter
from canonix.operators.merge import SkewConfig, merge_by_key, merge_row_count, _renamed_parts
from canonix.operators.standardize import standardize, standardize_all, trim_headers
from canonix.operators.values import (consolidate_values, distinct_consolidate, unique_values_across,
                                      unique_values_df, unique_values_single)
from canonix.plans.steps import StepEnv, run_steps
from canonix.session import ensure_checkpoint_dir, scratch_path
from canonix.sources import listing, sinks, tables, workbooks
from canonix.streaming.consolidate import consolidate_stream, read_consolidated

from canonix import _ship_by_value  # noqa: E402

_ship_by_value(__import__("sys").modules[__name__])  # the stub providers below run on Python workers

try:  # the training-data subpackage can be taken out without the rest
    import corpus_pipeline
    from canonix.llm.queries import QUERIES as LLM_QUERIES, SQL as LLM_SQL
except ImportError:
    corpus_pipeline, LLM_QUERIES, LLM_SQL = None, {}, {}

import entry_sources  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split()
MAPPED = ("customer", "supplier", "nation", "region", "orders", "lineitem", "part")


_READS: dict[tuple, DataFrame] = {}


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table's DataFrame, read once per session and folder (a plan, not data)."""
    k = (id(spark), sf, table)
    if k not in _READS:
        _READS[k] = spark.read.parquet(f"{sf}/{table}.parquet")
    return _READS[k]


def _load(spark: SparkSession, sf: str, names=MAPPED) -> dict[str, DataFrame]:
    return {f"{t}.parquet": _read(spark, sf, t) for t in names}


def _ds(*names: str) -> list[str]:
    return [f"{n}.parquet" for n in names]


# ---------------------------------------------------------------------------
# Flagship
# ---------------------------------------------------------------------------

def _merge_three_way(spark: SparkSession, sf: str) -> DataFrame:
    ds = _load(spark, sf, ("customer", "supplier", "nation"))
    return merge_by_key(testdata_map(), ds, "nation_key", order=_ds("customer", "supplier", "nation"))


def entry(spark: SparkSession) -> DataFrame:
    """Full outer merge of customer, supplier and nation on the canonical nation key."""
    ensure_checkpoint_dir(spark)
    return _merge_three_way(spark, SF_SMOKE)


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------

def _standardize_party(spark, sf):
    ds = _load(spark, sf)
    return standardize_all(ds, testdata_map())["customer.parquet"]


def _standardize_all(spark, sf):
    std = standardize_all(_load(spark, sf), testdata_map())
    parts = [df.withColumn("dataset", F.lit(name)) for name, df in sorted(std.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_FIRST_PRESENT_MAP = [
    {"canonical_name": "party_key", "data_type": "Integer",
     "original_columns": {"orders.parquet": ["o_customer", "o_custkey", "o_orderkey"]}},
    {"canonical_name": "status", "data_type": "String",
     "original_columns": {"orders.parquet": ["o_orderpriority", "o_orderstatus"]}},
    {"canonical_name": "order_key", "data_type": "Integer",
     "original_columns": {"orders.parquet": ["o_orderkey"]}},
    {"canonical_name": "order_key_again", "data_type": "Integer",
     "original_columns": {"orders.parquet": ["o_orderkey"]}},
]


def _standardize_first_present(spark, sf):
    hm = HarmonizationMap.from_obj(_FIRST_PRESENT_MAP)
    return standardize(_read(spark, sf, "orders"), "orders.parquet", hm)


def _standardize_nullfill(spark, sf):
    return standardize_all(_load(spark, sf), testdata_map())["region.parquet"]


def _trim_headers(spark, sf):
    n = _read(spark, sf, "nation")
    spaced = n.toDF(" n_nationkey", "n_name  ", " n_regionkey ")
    return trim_headers(spaced)


# ---------------------------------------------------------------------------
# Distinct values
# ---------------------------------------------------------------------------

def _unique_values_across(spark, sf):
    return unique_values_across(testdata_map(), _load(spark, sf), "nation_key")


def _unique_values_df(spark, sf):
    return unique_values_df(_read(spark, sf, "events"), "event_type")


def _unique_values_single(spark, sf):
    return unique_values_single(_read(spark, sf, "orders"), "orders.parquet", testdata_map(),
                                "status")


def _distinct_consolidate(spark, sf):
    base = scratch_path(spark, "consolidate")
    conv = _read(spark, sf, "conversations").select(F.col("role").alias("kind"), "conv_id")
    ev = _read(spark, sf, "events").select(F.col("event_type").alias("kind"), "event_id")
    cust = _read(spark, sf, "customer").select("c_name")  # lacks the column: skipped
    sinks.write_csv(conv, f"{base}/in/conversations.csv")
    sinks.write_csv(ev, f"{base}/in/events.csv")
    sinks.write_csv(cust, f"{base}/in/customer.csv")
    out = f"{base}/out/kinds.csv"
    distinct_consolidate(spark, [f"{base}/in/conversations.csv", f"{base}/in/customer.csv"], "kind", out)
    result, _ = distinct_consolidate(spark, [f"{base}/in/events.csv"], "kind", out)  # accumulates the prior run
    return result


def _consolidate_frames(spark, sf):
    conv = _read(spark, sf, "conversations").select(F.col("role").alias("kind"))
    ev = _read(spark, sf, "events").select(F.col("event_type").alias("kind"))
    return consolidate_values([conv, ev, _read(spark, sf, "customer")], "kind")


# ---------------------------------------------------------------------------
# Merges
# ---------------------------------------------------------------------------

def _merge_two_way(spark, sf):
    return merge_by_key(testdata_map(), _load(spark, sf, ("orders", "lineitem")), "order_key",
                        order=_ds("orders", "lineitem"))


def _merge_three_way_chain(spark, sf):
    ds = _load(spark, sf, ("customer", "supplier", "nation"))
    return merge_by_key(testdata_map(), ds, "nation_key", order=_ds("customer", "supplier", "nation"),
                        strategy="chain")


def _null_key_inputs(spark, sf):
    ds = _load(spark, sf, ("customer", "supplier", "nation"))
    ds["customer.parquet"] = ds["customer.parquet"].withColumn("c_nationkey",
                                                               F.expr("nullif(c_nationkey, 3)"))
    ds["supplier.parquet"] = ds["supplier.parquet"].withColumn("s_nationkey",
                                                               F.expr("nullif(s_nationkey, 5)"))
    return ds


def _merge_null_keys(spark, sf):
    return merge_by_key(testdata_map(), _null_key_inputs(spark, sf), "nation_key",
                        order=_ds("customer", "supplier", "nation"))


def _merge_unkeyed_file(spark, sf):
    ds = _load(spark, sf, ("customer", "supplier", "nation", "region"))
    return merge_by_key(testdata_map(), ds, "nation_key", order=_ds("customer", "supplier", "nation", "region"),
                        include_unkeyed=True, prune_null=True)


def _merge_hot_keys(spark, sf):
    # Thresholds small enough that most customer keys take the salted branch.
    skew = SkewConfig(input_rows=8, output_rows=16)
    return merge_by_key(testdata_map(), _load(spark, sf, ("customer", "orders")), "party_key",
                        order=_ds("customer", "orders"), prune_null=True, skew=skew)


def _merge_size_guard(spark, sf):
    hm = testdata_map()
    ds = _load(spark, sf, ("orders", "lineitem"))
    parts, _ = _renamed_parts(hm, ds, _ds("orders", "lineitem"), "order_key", True)
    return merge_row_count(parts, "order_key")


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

def _filter_by_value(spark, sf):
    std = standardize_all(_load(spark, sf, ("orders", "lineitem")), testdata_map())["orders.parquet"]
    return filter_by_value(std, "status", "F")


def _filter_typed_key(spark, sf):
    std = standardize_all(_load(spark, sf, ("orders", "lineitem")), testdata_map())["lineitem.parquet"]
    hit = filter_by_value(std, "order_key", "201")
    miss = filter_by_value(std, "order_key", "0201")  # not the text of any integer: no rows
    return hit.unionByName(miss)


def _filter_missing_column(spark, sf):
    std = standardize_all(_load(spark, sf, ("orders", "lineitem")), testdata_map())["orders.parquet"]
    return filter_by_value(std, "no_such_feature", "F")


def _merge_then_filter(spark, sf):
    return merge_then_filter(testdata_map(), _load(spark, sf, ("orders", "lineitem")), "status", "F",
                             key="order_key", order=_ds("orders", "lineitem"))


def _merge_filter_any(spark, sf):
    return merge_then_filter(testdata_map(), _load(spark, sf, ("orders", "lineitem")), "status", "F",
                             key="order_key", order=_ds("orders", "lineitem"), scope="any")


def _merge_filter_key(spark, sf):
    return merge_then_filter(testdata_map(), _load(spark, sf, ("orders", "lineitem")), "order_key", "201",
                             key="order_key", order=_ds("orders", "lineitem"))


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------

def _head_sample(spark, sf):
    return pf.head(_read(spark, sf, "orders"), 5, ["o_orderkey"])


def _preview_shape(spark, sf):
    merged = _merge_two_way(spark, sf)
    _, shape = sinks.preview(merged, 5, ["order_key"])
    return shape


def _preview_rows(spark, sf):
    """The rows of a preview: the first of the orders, standardized, in order of their key."""
    std = standardize_all(_load(spark, sf, ("orders", "lineitem")), testdata_map())["orders.parquet"]
    return sinks.preview(std, 5, ["order_key"])[0]


def _profile_shape(spark, sf):
    parts = [pf.shape(_read(spark, sf, t), f"{t}.parquet") for t in ALL_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _orders_with_nulls(spark, sf):
    return _read(spark, sf, "orders").withColumns({
        "o_orderstatus": F.expr("nullif(o_orderstatus, 'F')"),
        "o_orderpriority": F.expr("nullif(o_orderpriority, '3-MEDIUM')"),
    })


def _profile_null_counts(spark, sf):
    return pf.null_counts(_orders_with_nulls(spark, sf), "orders.parquet")


def _profile_unique_sample(spark, sf):
    return pf.unique_sample_head(_read(spark, sf, "part"), 5, ["p_partkey"], "part.parquet")


def _profile_unique_full(spark, sf):
    return pf.unique_sample_full(_read(spark, sf, "part"), 5, "part.parquet")


def _sample_json_records(spark, sf):
    rec = pf.sample_json_records(_read(spark, sf, "nation"), 5, ["n_nationkey"])
    back = rec.select(F.inline(F.from_json("records", "array<struct<n_nationkey:int,n_name:string,"
                                                      "n_regionkey:int>>")))
    return back


def _dataset_profile(spark, sf):
    """Everything of the profile: a row a column, with its dataset's shape, samples and metadata."""
    ds = {"customer.parquet": _read(spark, sf, "customer"),
          "orders.parquet": _orders_with_nulls(spark, sf)}
    meta = _read(spark, sf, "customer").agg(F.concat(F.lit("rows: "), F.count("*").cast("string")).alias("metadata_text")).select(
        F.lit("customer.parquet").alias("dataset"), "metadata_text")
    cols, dsp = pf.dataset_profile(ds, order_by={"customer.parquet": ["c_custkey"],
                                                 "orders.parquet": ["o_orderkey"]}, metadata=meta)
    first = F.get_json_object("sample_json", "$[0]")
    keys = F.expr("transform(from_json(sample_json, 'array<map<string,string>>'), x -> coalesce(x['c_custkey'], x['o_orderkey']))")
    return cols.join(dsp.select("dataset", "rows", "cols", "metadata", keys.alias("sample_keys"),
                                F.size(F.json_object_keys(first)).alias("sample_fields")), "dataset")


# ---------------------------------------------------------------------------
# Report and map
# ---------------------------------------------------------------------------

def _report(spark, sf):
    ds = _load(spark, sf)
    ds["orders.parquet"] = _orders_with_nulls(spark, sf)
    cols, dsp = pf.dataset_profile(ds, samples=False)
    return rp.harmonization_report(testdata_map().to_long_df(spark), cols, dsp)


def _harmonization_report(spark, sf):
    rep = _report(spark, sf)
    feats = rep.select(F.posexplode("harmonization_details").alias("feature_pos", "f"), "dataset_info")
    per_ds = feats.select("feature_pos", F.col("f.canonical_name").alias("canonical_name"),
                          F.explode("f.original_columns").alias("dataset", "cols"), "dataset_info")
    shape = F.try_element_at("dataset_info", F.col("dataset"))["shape"]
    return per_ds.select("feature_pos", "canonical_name", "dataset", shape.alias("shape"), F.inline("cols"))


def _feature_context(spark, sf):
    return rp.feature_context(_report(spark, sf))


def _map_long(spark, sf):
    """The v2 document produced from the data, normalized to the long table by the Spark reader."""
    from canonix.model import map_long_from_text

    doc = _report(spark, sf).select(F.to_json(F.struct("harmonization_details", "dataset_info")).alias("value"))
    return map_long_from_text(doc)


def _map_roundtrip(spark, sf):
    path = scratch_path(spark, "map") + "/harmonization_map.json"
    rp.write_map_json(_report(spark, sf), path)
    return load_map_long(spark, path)


# ---------------------------------------------------------------------------
# Column matching
# ---------------------------------------------------------------------------

_MATCH_TABLES = ALL_TABLES


def _match_columns_overlap(spark, sf):
    ds = _load(spark, sf, _MATCH_TABLES)
    cat = mt.column_catalog(spark, ds)
    ov = mt.value_overlap(ds, cat)
    parts = F.split("col_a", "\u0001"), F.split("col_b", "\u0001")
    return ov.select(
        parts[0][0].alias("dataset_a"), parts[0][1].alias("column_a"),
        parts[1][0].alias("dataset_b"), parts[1][1].alias("column_b"),
        "shared", "distinct_a", "distinct_b",
        _ratio6(F.col("shared"), F.col("distinct_a") + F.col("distinct_b") - F.col("shared")).alias("jaccard"),
        _ratio6(F.col("shared"), F.least("distinct_a", "distinct_b")).alias("containment"))


def _ratio6(num, den):
    """num/den as an exact 6-digit decimal (integer arithmetic, one IEEE division, half-up)."""
    ppm = F.round((num * 1000000) / den).cast("bigint")
    return (ppm.cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(10,6)")


def _match_columns_name(spark, sf):
    ds = _load(spark, sf, _MATCH_TABLES)
    return mt.match_columns(ds)


# ---------------------------------------------------------------------------
# Step lists
# ---------------------------------------------------------------------------

def _steps_env(spark, sf):
    return StepEnv(spark, testdata_map(), _load(spark, sf, ("orders", "lineitem")), folder=sf)


_STEPS_MERGE_FILTER = json.dumps([
    {"function": "merge_datasets_by_canonical_key",
     "args": {"harmonization_map": "_harmonization_map_", "data_folder_path": "_data_folder_path_",
              "merge_key_canonical_name": "order_key"},
     "output_variable": "merged_df"},
    {"function": "filter_dataframe_by_canonical_value",
     "args": {"df": "_merged_df_", "canonical_feature_name": "status", "value": "F"},
     "output_variable": "filtered_df"},
])

_STEPS_UNIQUE = json.dumps([
    {"function": "get_unique_values_for_canonical_feature",
     "args": {"harmonization_map": "_harmonization_map_", "canonical_feature_name": "status",
              "data_folder_path": "_data_folder_path_"},
     "output_variable": "unique_values_for_feature"},
])


def _steps_merge_filter(spark, sf):
    return run_steps(_STEPS_MERGE_FILTER, _steps_env(spark, sf))


def _steps_unique(spark, sf):
    return run_steps(_STEPS_UNIQUE, _steps_env(spark, sf))


# ---------------------------------------------------------------------------
# Scalar text functions
# ---------------------------------------------------------------------------

def _path_parts(spark, sf):
    p = _read(spark, sf, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    return p.select(
        "page_id",
        text.file_name(path).alias("file_name"),
        text.base_name(text.file_name(path)).alias("base_name"),
        text.extension(F.concat(text.file_name(path), F.lit(".html"))).alias("extension"),
        text.dots_to_underscores(F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)).alias("host_key"),
    )


def _split_trim_list(spark, sf):
    d = _read(spark, sf, "documents")
    parts = text.split_trim(F.concat_ws(" , ", "source", "lang", F.col("n_chars").cast("string")))
    return d.select("doc_id", F.posexplode(parts).alias("pos", "part"))


def _events_text(spark, sf):
    return _read(spark, sf, "events").select("event_id", "event_type", "props")


def _json_fence_strip(spark, sf):
    e = _events_text(spark, sf)
    fenced = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    return e.select("event_id", jsontext.strip_fences(fenced).alias("json_text"))


def _json_array_slice(spark, sf):
    e = _events_text(spark, sf)
    wrapped = F.concat(F.lit("Plan follows: "), F.lit("["), F.col("props"), F.lit(", ["), F.col("event_type"),
                       F.lit("]] trailing note"))
    return e.select("event_id", jsontext.array_slice(wrapped).alias("json_text"))


def _json_parse_repair(spark, sf):
    e = _events_text(spark, sf)
    # clicks lose their closing brace (a truncated response); errors lose their tail after the colon
    raw = (F.when(F.col("event_type") == "click", F.expr("substring(props, 1, length(props) - 1)"))
           .when(F.col("event_type") == "error", F.expr("substring_index(props, ':', 1)"))
           .otherwise(F.col("props")))
    out = jsontext.parse_repair_all(e.withColumn("raw", raw), "raw", "struct<k:bigint>")  # one UDF pass
    return out.select("event_id", "accepted", "json_text", F.col("parsed.k").alias("k"))


# ---------------------------------------------------------------------------
# Annotation with fallback
# ---------------------------------------------------------------------------

def _primary(s):
    """Stub provider: answers only for English documents."""
    import pandas as pd

    return pd.Series([f"en:{len(t.split('|', 1)[1])}" if t.startswith("en|") else None for t in s])


def _backup(s):
    """Stub provider: always answers."""
    import pandas as pd

    return pd.Series([f"len:{len(t.split('|', 1)[1])}" for t in s])


def _annotate_fallback(spark, sf):
    d = _read(spark, sf, "documents")
    inp = d.select("doc_id", F.concat(F.col("lang"), F.lit("|"), F.col("text")).alias("payload"))
    out = ann.annotate(inp, "payload", [("primary", _primary), ("backup", _backup)])
    return out.select("doc_id", "result", "provider")


# ---------------------------------------------------------------------------
# Sources and sinks (fresh folder under the checkpoint directory)
# ---------------------------------------------------------------------------

def _csv_scan_tolerant(spark, sf):
    base = scratch_path(spark, "csv-tolerant")
    o = _read(spark, sf, "orders")
    bad = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.lit("not-a-number"))
                       .otherwise(F.col("o_totalprice").cast("string")))
    sinks.write_csv(bad, f"{base}/orders.csv")
    return tables.read_csv(spark, f"{base}/orders.csv", o.schema)


def _csv_scan_na_tokens(spark, sf):
    base = scratch_path(spark, "csv-na")
    o = _read(spark, sf, "orders")
    token = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("NA"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.lit("null"))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("N/A"))
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("None")))
    src = o.withColumn("o_custkey", F.coalesce(token, F.col("o_custkey").cast("string")))
    src.write.option("header", True).option("emptyValue", "").csv(f"{base}/orders.csv")
    return tables.read_csv_na_tokens(spark, f"{base}/orders.csv", {f.name: f.dataType for f in o.schema.fields},
                                     na_tokens=("", "NA", "null", "N/A", "None"))


def _write_folder(spark, sf, base):
    """A folder of datasets derived from the tables, with sidecar metadata files."""
    o = _read(spark, sf, "orders")
    c = _read(spark, sf, "customer")
    n = _read(spark, sf, "nation")
    sinks.write_csv(o, f"{base}/orders.csv")
    c.write.parquet(f"{base}/customer.parquet")
    sinks.write_csv(n, f"{base}/nation.CSV")
    # sidecars: text derived from each table, written by Spark as single text files
    meta = [("orders", ".json", o), ("orders", ".md", o), ("customer", ".md", c), ("customer", ".yml", c)]
    for stem, ext, df in meta:
        df.agg(F.format_string("rows: %d", F.count(F.lit(1))).alias("value")).coalesce(1).write.text(
            f"{base}/.stage-{stem}{ext}")
        _promote_single_file(spark, f"{base}/.stage-{stem}{ext}", f"{base}/{stem}{ext}")
    return base


def _promote_single_file(spark, folder, target):
    """Move the one part file Spark wrote in ``folder`` to the file path ``target``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(folder)
    fs = src_dir.getFileSystem(conf)
    part = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")][0]
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(target))


def _folder_inventory(spark, sf):
    base = _write_folder(spark, sf, scratch_path(spark, "folder"))
    inv = listing.folder_inventory(spark, base).where(F.col("kind") == "tabular")
    datasets, _ = tables.load_folder(spark, base)
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(name))
              for name, df in datasets.items()]
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    return inv.select("dataset", "extension", "kind").join(rows, "dataset")


def _sidecar_pairing(spark, sf):
    base = _write_folder(spark, sf, scratch_path(spark, "sidecar"))
    return listing.sidecar_pairing(spark, base)


def _recursive_discovery(spark, sf):
    base = scratch_path(spark, "discovery")
    sinks.write_csv(_read(spark, sf, "region"), f"{base}/a/region")
    sinks.write_csv(_read(spark, sf, "nation"), f"{base}/a/b/nation")
    _read(spark, sf, "supplier").write.parquet(f"{base}/c/supplier")
    found = listing.recursive_discovery(spark, base, [".csv"])
    data = (spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .csv(base).select(F.col("_metadata.file_path").alias("path")))
    per = data.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    folder = F.regexp_extract("relative_path", r"^(.*)/[^/]+$", 1)
    return found.join(per, "path").groupBy(folder.alias("folder")).agg(F.sum("rows").alias("rows"))


def _sink_text_roundtrip(spark, sf):
    path = scratch_path(spark, "text")
    vals = unique_values_across(testdata_map(), _load(spark, sf), "party_key")
    sinks.write_text(vals, path)
    return spark.read.text(path).select(F.col("value").alias("party_key"))


def _sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    std = standardize_all(_load(spark, sf, ("orders", "lineitem")), testdata_map())["orders.parquet"]
    sinks.write_csv(std, path)
    return tables.read_csv(spark, path, std.schema)


def _workbook_folder_scan(spark, sf):
    c = _read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    # one workbook per range of keys, at most ~50k rows each (a sheet is bounded)
    n_books = max(1, -(-c.count() // 50_000))
    binary = workbooks.encode_partitions(c.repartitionByRange(n_books, "c_custkey"), "customer")
    rows = workbooks.decode_workbooks(binary)
    header = c.columns
    return workbooks.typed_table(rows, header).drop("row_no")


def _distinct_consolidate_stream(spark, sf):
    import pyspark.sql.types as T

    base = scratch_path(spark, "stream")
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("src_id", T.LongType())])
    conv = _read(spark, sf, "conversations").select(F.col("role").alias("kind"),
                                                                    F.col("conv_id").alias("src_id"))
    ev = _read(spark, sf, "events").select(F.col("event_type").alias("kind"),
                                                           F.col("event_id").alias("src_id"))
    sinks.write_csv(conv, f"{base}/in/batch1")
    consolidate_stream(spark, f"{base}/in/*", "kind", f"{base}/out", f"{base}/ckpt", schema)
    sinks.write_csv(ev, f"{base}/in/batch2")
    consolidate_stream(spark, f"{base}/in/*", "kind", f"{base}/out", f"{base}/ckpt", schema)
    return read_consolidated(spark, f"{base}/out", "kind")


def _ensure_map(spark, sf):
    from canonix.plans.workflow import ensure_map

    path = scratch_path(spark, "auto-map") + "/harmonization_map.json"
    _read(spark, sf, "region").select(F.lit("no map")).write.text(path)  # not a map: a new one takes its place
    hm = ensure_map(spark, _load(spark, sf, ALL_TABLES), path, replace_invalid=True)
    return hm.to_long_df(spark)


def _folder_analysis(spark, sf):
    """The profile of a folder with its sidecar text, as the analysis keeps it."""
    from canonix.plans.workflow import analyze_folder

    found, _ = analyze_folder(spark, _write_folder(spark, sf, scratch_path(spark, "analysis")))
    return found.dataset_profile.select("dataset", "rows", "cols", "metadata", F.size(F.from_json("sample_json", "array<string>")).alias("sampled"))


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "standardize_party": _standardize_party,
        "standardize_all": _standardize_all,
        "standardize_first_present": _standardize_first_present,
        "standardize_nullfill": _standardize_nullfill,
        "trim_headers": _trim_headers,
        "unique_values_across": _unique_values_across,
        "unique_values_df": _unique_values_df,
        "unique_values_single": _unique_values_single,
        "distinct_consolidate": _distinct_consolidate,
        "consolidate_frames": _consolidate_frames,
        "merge_two_way": _merge_two_way,
        "merge_three_way": _merge_three_way,
        "merge_three_way_chain": _merge_three_way_chain,
        "merge_null_keys": _merge_null_keys,
        "merge_unkeyed_file": _merge_unkeyed_file,
        "merge_hot_keys": _merge_hot_keys,
        "merge_size_guard": _merge_size_guard,
        "filter_by_value": _filter_by_value,
        "filter_typed_key": _filter_typed_key,
        "filter_missing_column": _filter_missing_column,
        "merge_then_filter": _merge_then_filter,
        "merge_filter_any": _merge_filter_any,
        "merge_filter_key": _merge_filter_key,
        "head_sample": _head_sample,
        "preview_shape": _preview_shape,
        "preview_rows": _preview_rows,
        "profile_shape": _profile_shape,
        "profile_null_counts": _profile_null_counts,
        "profile_unique_sample": _profile_unique_sample,
        "profile_unique_full": _profile_unique_full,
        "sample_json_records": _sample_json_records,
        "dataset_profile": _dataset_profile,
        "harmonization_report": _harmonization_report,
        "feature_context": _feature_context,
        "map_long": _map_long,
        "map_roundtrip": _map_roundtrip,
        "match_columns_overlap": _match_columns_overlap,
        "match_columns_name": _match_columns_name,
        "steps_merge_filter": _steps_merge_filter,
        "steps_unique": _steps_unique,
        "path_parts": _path_parts,
        "split_trim_list": _split_trim_list,
        "json_fence_strip": _json_fence_strip,
        "json_array_slice": _json_array_slice,
        "json_parse_repair": _json_parse_repair,
        "annotate_fallback": _annotate_fallback,
        "csv_scan_tolerant": _csv_scan_tolerant,
        "csv_scan_na_tokens": _csv_scan_na_tokens,
        "folder_inventory": _folder_inventory,
        "sidecar_pairing": _sidecar_pairing,
        "recursive_discovery": _recursive_discovery,
        "sink_text_roundtrip": _sink_text_roundtrip,
        "sink_csv_roundtrip": _sink_csv_roundtrip,
        "workbook_folder_scan": _workbook_folder_scan,
        "distinct_consolidate_stream": _distinct_consolidate_stream,
        "ensure_map": _ensure_map,
        "folder_analysis": _folder_analysis,
        **entry_sources.QUERIES,
        **LLM_QUERIES,
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }




# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB), generated from the same fixture map
# ---------------------------------------------------------------------------

_DUCK = {"Integer": "BIGINT", "String": "VARCHAR", "Float": "DOUBLE"}
# Physical columns outside the declared vocabulary (pass through untouched).
_NONBASIC = {("orders.parquet", "o_orderdate"): "TIMESTAMP", ("lineitem.parquet", "l_shipdate"): "TIMESTAMP"}
# Spark type names of the tables' columns (fixed values of the test data).
_SPARK_TYPES = {table: [tuple(c.split(":")) for c in cols.split()] for table, cols in {
    "region": "r_regionkey:int r_name:string",
    "nation": "n_nationkey:int n_name:string n_regionkey:int",
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "supplier": "s_suppkey:bigint s_name:string s_nationkey:int s_acctbal:double",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority:string",
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double l_extendedprice:double l_discount:double "
                "l_tax:double l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz",
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double props:string",
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
    "embeddings": "vec_id:bigint embedding:array<float> label:int",
    "pages": "page_id:bigint url:string html:string",
    "benchmark": "item_id:bigint text:string",
    "labels": "doc_id:bigint quality:int toxic:int",
    "conversations": "conv_id:bigint turn:bigint role:string text:string",
}.items()}
# Features that matching must find in the tables: name, type, columns (fixed values, set by hand).
_MATCHED = [(name, kind, columns.split()) for name, kind, columns in (
    ("acctbal", "Float", "customer.c_acctbal supplier.s_acctbal"), ("brand", "String", "part.p_brand"), ("conv_id", "Integer", "conversations.conv_id"),
    ("custkey", "Integer", "customer.c_custkey orders.o_custkey"), ("discount", "Float", "lineitem.l_discount"),
    ("doc_id", "Integer", "documents.doc_id labels.doc_id"), ("embedding", "String", "embeddings.embedding"), ("event_id", "Integer", "events.event_id"),
    ("event_type", "String", "events.event_type part.p_type"), ("extendedprice", "Float", "lineitem.l_extendedprice"), ("html", "String", "pages.html"),
    ("item_id", "Integer", "benchmark.item_id"), ("label", "Integer", "embeddings.label"), ("lang", "String", "documents.lang"),
    ("linenumber", "Integer", "lineitem.l_linenumber"), ("linestatus", "String", "lineitem.l_linestatus orders.o_orderstatus"),
    ("mktsegment", "String", "customer.c_mktsegment"), ("n_chars", "Integer", "documents.n_chars"),
    ("name", "String", "customer.c_name nation.n_name part.p_name region.r_name supplier.s_name"),
    ("nationkey", "Integer", "customer.c_nationkey nation.n_nationkey supplier.s_nationkey"), ("orderdate", "String", "orders.o_orderdate"),
    ("orderkey", "Integer", "lineitem.l_orderkey orders.o_orderkey"), ("orderpriority", "String", "orders.o_orderpriority"),
    ("page_id", "Integer", "pages.page_id"), ("partkey", "Integer", "lineitem.l_partkey part.p_partkey"), ("props", "String", "events.props"),
    ("quality", "Integer", "labels.quality"), ("quantity", "Float", "lineitem.l_quantity"),
    ("regionkey", "Integer", "nation.n_regionkey region.r_regionkey"), ("retailprice", "Float", "part.p_retailprice"),
    ("returnflag", "String", "lineitem.l_returnflag"), ("role", "String", "conversations.role"), ("shipdate", "String", "lineitem.l_shipdate"),
    ("size", "Integer", "part.p_size"), ("source", "String", "documents.source"), ("suppkey", "Integer", "lineitem.l_suppkey supplier.s_suppkey"),
    ("tax", "Float", "lineitem.l_tax"), ("text", "String", "benchmark.text conversations.text documents.text"), ("totalprice", "Float", "orders.o_totalprice"),
    ("toxic", "Integer", "labels.toxic"), ("ts", "String", "events.ts"), ("turn", "Integer", "conversations.turn"), ("url", "String", "pages.url"),
    ("user_id", "Integer", "events.user_id"), ("value", "Float", "events.value"), ("vec_id", "Integer", "embeddings.vec_id"))]
_ORDERS_NULLS = ("(SELECT * REPLACE (nullif(o_orderstatus, 'F') AS o_orderstatus, "
                 "nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority) FROM orders)")


def _vocabulary(spark_type: str) -> str:
    return {"bigint": "Integer", "int": "Integer", "double": "Float"}.get(spark_type, "String")


def _matched_sql(as_document: bool) -> str:
    """The long map of ``_MATCHED``; as a document has it, with its types and null counts."""
    parts = []
    for pos, (name, kind, columns) in enumerate(_MATCHED):
        for c in columns:
            table, column = c.split(".")
            t = dict(_SPARK_TYPES[table])[column]
            test = f"{column} IS NULL" + (f" OR isnan({column})" if t == "double" else "")
            nulls = f"(SELECT count(*) FILTER ({test}) FROM {table})" if as_document else "CAST(NULL AS BIGINT)"
            parts.append(f"SELECT {pos} AS feature_pos, '{name}' AS canonical_name, CAST(NULL AS VARCHAR) AS semantic_meaning, '{kind}' AS data_type, "
                         f"'{table}.parquet' AS dataset, 0 AS cand_pos, '{column}' AS column_name, '{_vocabulary(t) if as_document else t}' AS column_type, "
                         f"{nulls} AS nan_count")
    return " UNION ALL ".join(parts)


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _sql_types(hm: HarmonizationMap, names) -> dict[str, str]:
    out = {}
    for f in hm.features:
        t = _DUCK[f.data_type]
        for n in names:
            c = f.candidates(n)
            if c and (n, c[0]) in _NONBASIC:
                t = _NONBASIC[(n, c[0])]
                break
        out[f.canonical_name] = t
    return out


def _std_sql(hm, name, types, rename=lambda c: c, keep=lambda f: True, source=None) -> str:
    exprs = []
    for f in hm.features:
        if not keep(f):
            continue
        out = _q(rename(f.canonical_name))
        cands = f.candidates(name)
        t = types[f.canonical_name]
        if cands:
            c = _q(cands[0])
            exprs.append(f"{c} AS {out}" if t == "TIMESTAMP" else f"CAST({c} AS {t}) AS {out}")
        else:
            exprs.append(f"CAST(NULL AS {t}) AS {out}")
    return f"SELECT {', '.join(exprs)} FROM {source or name.split('.')[0]}"


def _merge_sql(names, key, prune=False, sources=None, hm=None) -> str:
    hm = hm or testdata_map()
    types = _sql_types(hm, names)
    ctes, cols, keys = [], [], []
    for i, n in enumerate(names):
        def rename(c, i=i, n=n):
            return c if (i == 0 or c == key) else c + "_from_" + n.replace(".", "_")

        def keep(f, n=n):
            return f.canonical_name == key or not prune or bool(f.candidates(n))

        ctes.append(f"t{i} AS ({_std_sql(hm, n, types, rename, keep, (sources or {}).get(n))})")
        cols += [f"t{i}.{_q(rename(f.canonical_name))}" for f in hm.features
                 if f.canonical_name != key and keep(f)]
        keys.append(f"t{i}.{_q(key)}")
    body = "t0"
    for i in range(1, len(names)):
        left = keys[0] if i == 1 else f"COALESCE({', '.join(keys[:i])})"
        body += f" FULL JOIN t{i} ON {left} = {keys[i]}"
    key_expr = keys[0] if len(keys) == 1 else f"COALESCE({', '.join(keys)})"
    return f"WITH {', '.join(ctes)} SELECT {key_expr} AS {_q(key)}, {', '.join(cols)} FROM {body}"


def _distinct_text(alias: str, selects) -> str:
    u = " UNION ALL ".join(selects)
    return f"SELECT DISTINCT CAST(v AS VARCHAR) AS {alias} FROM ({u}) WHERE v IS NOT NULL"


def _null_counts_sql(table, source, dataset) -> str:
    parts = []
    for i, (c, t) in enumerate(_SPARK_TYPES[table]):
        test = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
        parts.append(f"SELECT '{dataset}' AS dataset, {i} AS position, '{c}' AS column_name, "
                     f"CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
                     f"COUNT(*) AS rows FROM {source}")
    return " UNION ALL ".join(parts)


def _report_rows_sql(with_meta: bool) -> str:
    hm = testdata_map()
    phys = {t: dict(c) for t, c in _SPARK_TYPES.items()}
    parts = []
    for fpos, f in enumerate(hm.features):
        for ds, refs in f.original_columns.items():
            table = ds.split(".")[0]
            src = _ORDERS_NULLS if table == "orders" else table
            for cpos, r in enumerate(refs):
                c = r.column_name
                t = phys[table][c]
                test = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
                meta = (f"'{f.semantic_meaning}' AS semantic_meaning, '{f.data_type}' AS data_type, "
                        f"{cpos} AS cand_pos, " if with_meta else f"[(SELECT count(*) FROM {table}), {len(phys[table])}] AS shape, ")
                parts.append(
                    f"SELECT {fpos} AS feature_pos, '{f.canonical_name}' AS canonical_name, {meta}'{ds}' AS dataset, "
                    f"'{c}' AS column_name, '{_vocabulary(t)}' AS {'column_type' if with_meta else 'data_type'}, "
                    f"CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS nan_count FROM {src}")
    return " UNION ALL ".join(parts)


def _overlap_sql() -> str:
    fam = {"bigint": "Integer", "int": "Integer", "double": "Float", "string": "String"}
    cols = {t: [c for c in cs if c[1] in fam] for t, cs in _SPARK_TYPES.items()}
    vals = []
    for t, cs in cols.items():
        for c, ty in cs:
            vals.append(f"SELECT DISTINCT '{t}.parquet' AS ds, '{c}' AS col, '{fam[ty]}' AS fam, "
                        f"CAST({c} AS VARCHAR) AS val FROM {t} WHERE {c} IS NOT NULL")
    v = " UNION ALL ".join(vals)
    return (
        f"WITH v AS ({v}), nd AS (SELECT ds, col, COUNT(*) AS n FROM v GROUP BY ds, col), "
        "sh AS (SELECT a.ds AS ds_a, a.col AS col_a, b.ds AS ds_b, b.col AS col_b, COUNT(*) AS shared "
        "FROM v a JOIN v b ON a.val = b.val AND a.ds < b.ds AND a.fam = b.fam GROUP BY ALL) "
        "SELECT sh.ds_a AS dataset_a, sh.col_a AS column_a, sh.ds_b AS dataset_b, sh.col_b AS column_b, "
        "sh.shared, na.n AS distinct_a, nb.n AS distinct_b, "
        "CAST(CAST(round((sh.shared * 1000000) / (na.n + nb.n - sh.shared)) AS BIGINT) / 1000000 AS DECIMAL(10,6))"
        " AS jaccard, "
        "CAST(CAST(round((sh.shared * 1000000) / least(na.n, nb.n)) AS BIGINT) / 1000000 AS DECIMAL(10,6))"
        " AS containment "
        "FROM sh JOIN nd na ON na.ds = sh.ds_a AND na.col = sh.col_a JOIN nd nb ON nb.ds = sh.ds_b AND nb.col = sh.col_b"
    )


def oracle_sql() -> dict[str, str]:
    hm = testdata_map()
    mapped = [f"{t}.parquet" for t in MAPPED]
    t_all = _sql_types(hm, mapped)
    t_ol = _sql_types(hm, _ds("orders", "lineitem"))
    three = _ds("customer", "supplier", "nation")
    merge_ol = _merge_sql(_ds("orders", "lineitem"), "order_key")
    kinds = _distinct_text("kind", ["SELECT role AS v FROM conversations", "SELECT event_type AS v FROM events"])
    nation_vals = ["SELECT c_nationkey AS v FROM customer", "SELECT s_nationkey AS v FROM supplier",
                   "SELECT n_nationkey AS v FROM nation"]
    uniq_head = []
    for i, (c, _t) in enumerate(_SPARK_TYPES["part"]):
        uniq_head.append(f"SELECT {i} AS position, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, pos FROM h")
    uniq_full = []
    for i, (c, _t) in enumerate(_SPARK_TYPES["part"]):
        uniq_full.append(
            f"SELECT 'part.parquet' AS dataset, {i} AS position, '{c}' AS column_name, "
            f"list(CAST(v AS VARCHAR) ORDER BY v) AS \"values\" FROM "
            f"(SELECT DISTINCT {c} AS v FROM part WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)")
    prof_cols = []
    for table, src, key in (("customer", "customer", "c_custkey"), ("orders", _ORDERS_NULLS, "o_orderkey")):
        for i, (c, t) in enumerate(_SPARK_TYPES[table]):
            test = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
            prof_cols.append(
                f"SELECT '{table}.parquet' AS dataset, {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
                f"CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
                f"(SELECT list(v ORDER BY p) FROM (SELECT CAST({c} AS VARCHAR) AS v, min(p) AS p FROM (SELECT *, row_number() OVER (ORDER BY {key}) AS p "
                f"FROM {src} ORDER BY {key} LIMIT 5) GROUP BY v)) AS unique_sample, COUNT(*) AS rows, "
                f"{len(_SPARK_TYPES[table])} AS cols, {'$$rows: $$ || COUNT(*)' if table == 'customer' else 'CAST(NULL AS VARCHAR)'} AS metadata, "
                f"(SELECT list(CAST({key} AS VARCHAR) ORDER BY {key}) FROM (SELECT {key} FROM {src} ORDER BY {key} LIMIT 5)) AS sample_keys, "
                f"(SELECT {' + '.join(f'CAST({x} IS NOT NULL AS INTEGER)' for x, _ in _SPARK_TYPES[table])} FROM {src} ORDER BY {key} LIMIT 1) AS sample_fields "
                f"FROM {src}")
    ds_lines = []
    ncols = {"customer": 5, "lineitem": 11, "nation": 3, "orders": 6, "part": 6, "region": 2, "supplier": 4}
    for i, t in enumerate(sorted(MAPPED)):
        ds_lines.append(f"SELECT 'datasets' AS section, {i} AS ord, "
                        f"'- {t}.parquet: Shape [' || COUNT(*) || ', {ncols[t]}]' AS line FROM {t}")
    feat_lines = [f"SELECT 'features' AS section, {i} AS ord, "
                  f"'- {f.canonical_name}: {f.semantic_meaning} (Type: {f.data_type})' AS line"
                  for i, f in enumerate(hm.features)]
    null_src = {"customer.parquet": "(SELECT * REPLACE (nullif(c_nationkey, 3) AS c_nationkey) FROM customer)",
                "supplier.parquet": "(SELECT * REPLACE (nullif(s_nationkey, 5) AS s_nationkey) FROM supplier)"}
    shape_parts = [f"SELECT '{t}.parquet' AS dataset, COUNT(*) AS rows, "
                   f"(SELECT CAST(COUNT(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS cols "
                   f"FROM {t}" for t in ALL_TABLES]
    std_all = " UNION ALL ".join(
        f"SELECT *, '{n}' AS dataset FROM ({_std_sql(hm, n, t_all)})" for n in sorted(mapped))
    fenced = "'```json' || chr(10) || props || chr(10) || '```'"
    wrapped = "'Plan follows: [' || props || ', [' || event_type || ']] trailing note'"
    return {
        "standardize_party": _std_sql(hm, "customer.parquet", t_all),
        "standardize_all": std_all,
        "standardize_first_present": ("SELECT o_custkey AS party_key, o_orderpriority AS status, "
                                      "o_orderkey AS order_key, o_orderkey AS order_key_again FROM orders"),
        "standardize_nullfill": _std_sql(hm, "region.parquet", t_all),
        "trim_headers": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
        "unique_values_across": _distinct_text("nation_key", nation_vals),
        "unique_values_df": "SELECT DISTINCT event_type FROM events",
        "unique_values_single": "SELECT DISTINCT CAST(o_orderstatus AS VARCHAR) AS status FROM orders",
        "distinct_consolidate": kinds,
        "consolidate_frames": kinds,
        "merge_two_way": merge_ol,
        "merge_three_way": _merge_sql(three, "nation_key"),
        "merge_three_way_chain": _merge_sql(three, "nation_key"),
        "merge_null_keys": _merge_sql(three, "nation_key", sources=null_src),
        "merge_unkeyed_file": _merge_sql(_ds("customer", "supplier", "nation", "region"), "nation_key", prune=True),
        "merge_hot_keys": _merge_sql(_ds("customer", "orders"), "party_key", prune=True),
        "merge_size_guard": f"SELECT CAST(COUNT(*) AS BIGINT) AS rows FROM ({merge_ol})",
        "filter_by_value": f"SELECT * FROM ({_std_sql(hm, 'orders.parquet', t_ol)}) WHERE status = 'F'",
        "filter_typed_key": f"SELECT * FROM ({_std_sql(hm, 'lineitem.parquet', t_ol)}) WHERE order_key = 201",
        "filter_missing_column": f"SELECT * FROM ({_std_sql(hm, 'orders.parquet', t_ol)}) WHERE FALSE",
        "merge_then_filter": f"SELECT * FROM ({merge_ol}) WHERE status = 'F'",
        "merge_filter_any": (f"SELECT * FROM ({merge_ol}) WHERE status = 'F' "
                             "OR status_from_lineitem_parquet = 'F'"),
        "merge_filter_key": f"SELECT * FROM ({merge_ol}) WHERE order_key = 201",
        "head_sample": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
        "preview_rows": f"SELECT * FROM ({_std_sql(hm, 'orders.parquet', t_ol)}) ORDER BY order_key LIMIT 5",
        "preview_shape": f"SELECT COUNT(*) AS rows, 23 AS cols FROM ({merge_ol})",
        "profile_shape": " UNION ALL ".join(shape_parts),
        "profile_null_counts": _null_counts_sql("orders", _ORDERS_NULLS, "orders.parquet"),
        "profile_unique_sample": (
            "WITH h AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS pos FROM "
            "(SELECT * FROM part ORDER BY p_partkey LIMIT 5)), "
            f"u AS (SELECT position, column_name, value, MIN(pos) AS fp FROM ({' UNION ALL '.join(uniq_head)}) "
            "GROUP BY ALL) SELECT 'part.parquet' AS dataset, position, column_name, "
            "list(value ORDER BY fp) AS \"values\" FROM u GROUP BY ALL"),
        "profile_unique_full": " UNION ALL ".join(uniq_full),
        "sample_json_records": "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 5",
        "dataset_profile": " UNION ALL ".join(prof_cols),
        "harmonization_report": _report_rows_sql(False),
        "feature_context": " UNION ALL ".join(feat_lines + ds_lines),
        "map_long": _report_rows_sql(True),
        "map_roundtrip": _report_rows_sql(True),
        "match_columns_overlap": _overlap_sql(),
        "match_columns_name": _matched_sql(False),
        "ensure_map": _matched_sql(True),
        "folder_analysis": (
            "SELECT 'orders.csv' AS dataset, count(*) AS rows, 6 AS cols, 'rows: ' || count(*) || chr(10) AS metadata, 5 AS sampled FROM orders "
            "UNION ALL SELECT 'customer.parquet', count(*), 5, 'rows: ' || count(*) || chr(10), 5 FROM customer "
            "UNION ALL SELECT 'nation.CSV', count(*), 3, NULL, 5 FROM nation"),
        "steps_merge_filter": f"SELECT * FROM ({_merge_sql(_ds('lineitem', 'orders'), 'order_key')}) "
                              "WHERE status = 'F'",
        "steps_unique": _distinct_text("status", ["SELECT o_orderstatus AS v FROM orders",
                                                  "SELECT l_linestatus AS v FROM lineitem"]),
        "path_parts": (
            "WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path FROM pages), "
            "f AS (SELECT page_id, url, string_split(path, '/')[-1] AS fname FROM p) "
            "SELECT page_id, fname AS file_name, regexp_extract(fname, '^(.+?)(\\.[^.]*)?$', 1) AS base_name, "
            "regexp_extract(fname || '.html', '^.+(\\.[^.]*)$', 1) AS extension, "
            "translate(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '.', '_') AS host_key FROM f"),
        "split_trim_list": (
            "SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS part FROM "
            "(SELECT doc_id, list_transform(string_split(concat_ws(' , ', source, lang, CAST(n_chars AS VARCHAR)), "
            "','), lambda x: trim(x)) AS l FROM documents)"),
        "json_fence_strip": (
            f"SELECT event_id, regexp_replace(regexp_replace({fenced}, '```(json)?', '', 'g'), "
            "'^\\s+|\\s+$', '', 'g') AS json_text FROM events"),
        "json_array_slice": (
            f"SELECT event_id, substring(s, instr(s, '['), (length(s) - instr(reverse(s), ']') + 1) - instr(s, '[') + 1)"
            f" AS json_text FROM (SELECT event_id, {wrapped} AS s FROM events)"),
        "json_parse_repair": (
            "SELECT event_id, accepted, json_text, CAST(json_extract_string(json_text, '$.k') AS BIGINT) AS k FROM ("
            "SELECT event_id, event_type <> 'error' AS accepted, CASE WHEN event_type = 'click' "
            "THEN substring(props, 1, length(props) - 1) || '}' WHEN event_type = 'error' THEN NULL ELSE props END "
            "AS json_text FROM events)"),
        "annotate_fallback": (
            "SELECT doc_id, CASE WHEN lang = 'en' THEN 'en:' ELSE 'len:' END || length(text) AS result, "
            "CASE WHEN lang = 'en' THEN 'primary' ELSE 'backup' END AS provider FROM documents"),
        "csv_scan_tolerant": ("SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END "
                              "AS o_totalprice) FROM orders"),
        "csv_scan_na_tokens": (
            "SELECT * REPLACE (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') "
            "THEN NULL ELSE o_custkey END AS o_custkey) FROM orders"),
        "folder_inventory": (
            "SELECT 'orders.csv' AS dataset, '.csv' AS extension, 'tabular' AS kind, COUNT(*) AS rows FROM orders "
            "UNION ALL SELECT 'customer.parquet', '.parquet', 'tabular', COUNT(*) FROM customer "
            "UNION ALL SELECT 'nation.CSV', '.csv', 'tabular', COUNT(*) FROM nation"),
        "sidecar_pairing": (
            "SELECT 'orders.csv' AS dataset, 'orders.json' AS metadata_file, "
            "'rows: ' || COUNT(*) || chr(10) AS metadata_text FROM orders "
            "UNION ALL SELECT 'customer.parquet', 'customer.yml', 'rows: ' || COUNT(*) || chr(10) FROM customer "
            "UNION ALL SELECT 'nation.CSV', NULL, NULL"),
        "recursive_discovery": ("SELECT 'a/region' AS folder, COUNT(*) AS rows FROM region "
                                "UNION ALL SELECT 'a/b/nation', COUNT(*) FROM nation"),
        "sink_text_roundtrip": _distinct_text("party_key", ["SELECT c_custkey AS v FROM customer",
                                                            "SELECT s_suppkey AS v FROM supplier",
                                                            "SELECT o_custkey AS v FROM orders"]),
        "sink_csv_roundtrip": _std_sql(hm, "orders.parquet", t_ol),
        "workbook_folder_scan": ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal "
                                 "FROM customer"),
        "distinct_consolidate_stream": kinds,
        **entry_sources.SQL,
        "merge_layout_csv": _merge_sql(three, "nation_key"),
        **LLM_SQL,
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
    }


__all__ = ["entry", "queries", "oracle_sql", "TESTDATA_MAP_V1"]
