import os

from canonix.operators import match as mt
from canonix.operators.values import consolidate_values
from canonix.streaming.consolidate import consolidate_stream, read_consolidated
from conftest import SF


def test_stream_equals_batch(spark, tmpdir_path):
    from pyspark.sql import types as T

    a = spark.createDataFrame([("x", 1), ("y", 2)], "CELL_LINE string, n bigint")
    b = spark.createDataFrame([("y", 3), ("z", 4), (None, 5)], "CELL_LINE string, n bigint")
    schema = T.StructType([T.StructField("CELL_LINE", T.StringType()), T.StructField("n", T.LongType())])
    a.write.option("header", True).csv(f"{tmpdir_path}/in/a")
    consolidate_stream(spark, f"{tmpdir_path}/in/*", "CELL_LINE", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", schema)
    b.write.option("header", True).csv(f"{tmpdir_path}/in/b")
    consolidate_stream(spark, f"{tmpdir_path}/in/*", "CELL_LINE", f"{tmpdir_path}/out", f"{tmpdir_path}/ck", schema)
    got = [r.CELL_LINE for r in read_consolidated(spark, f"{tmpdir_path}/out", "CELL_LINE").collect()]
    assert got == [r.CELL_LINE for r in consolidate_values([a, b], "CELL_LINE").collect()] == ["x", "y", "z"]


def test_overlap_false_friend_and_matching(spark):
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "part", "supplier", "nation")}
    cat = mt.column_catalog(spark, ds)
    ov = {(r.col_a, r.col_b): r.shared for r in mt.value_overlap(ds, cat).collect()}
    assert ov[("customer.parquet\u0001c_custkey", "part.parquet\u0001p_partkey")] == 1500
    long_map = mt.match_columns(ds).collect()
    groups = {}
    for r in long_map:
        groups.setdefault(r.canonical_name, set()).add(r.column_name)
    # dense integer keys overlap but do not share a name: kept apart
    assert not any({"c_custkey", "p_partkey"} <= g for g in groups.values())
    assert any({"c_nationkey", "s_nationkey", "n_nationkey"} <= g for g in groups.values())


def test_entry_smoke(spark):
    import importlib
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0 and "nation_key" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_harmonize_folder(spark, tmpdir_path):
    from canonix.plans.workflow import harmonize_folder

    d = tmpdir_path
    spark.createDataFrame([(1, "a"), (2, "b")], "a_id bigint, a_name string").write.option("header", True).csv(
        f"{d}/a.csv")
    spark.createDataFrame([(2, "b"), (3, "c")], "b_id bigint, b_name string").write.option("header", True).csv(
        f"{d}/b.csv")
    with open(f"{d}/a.md", "w") as f:
        f.write("notes")
    report, cols, map_long, skipped = harmonize_folder(spark, d)
    groups = {}
    for r in map_long.collect():
        groups.setdefault(r.canonical_name, set()).add((r.dataset, r.column_name))
    assert {("a.csv", "a_id"), ("b.csv", "b_id")} in groups.values()
    rep = report.collect()[0]
    assert rep.dataset_info["a.csv"].shape == [2, 2]
    assert skipped == [("a.md", "unsupported extension .md")]


def test_name_pairs_tokens_and_edits(spark):
    a = spark.createDataFrame([(1, "x", 1)], "DRUG_ID bigint, CELL_LINE_NAME string, nationkey bigint")
    b = spark.createDataFrame([(1, "x", 1)], "DrugID bigint, CELL_LINE string, regionkey bigint")
    cat = mt.column_catalog(spark, {"a.csv": a, "b.csv": b})
    got = {(r.col_a.split("\u0001")[1], r.col_b.split("\u0001")[1]): round(r.name_score, 3)
           for r in mt.name_pairs(cat).collect()}
    assert got[("DRUG_ID", "DrugID")] == 1.0
    assert got[("CELL_LINE_NAME", "CELL_LINE")] == round(2 / 3, 3)
    assert ("nationkey", "regionkey") not in got


def test_connected_components_chain_and_islands(spark):
    ids = [f"v{i:02d}" for i in range(12)]
    chain = [(ids[i], ids[i + 1]) for i in range(7)]  # v00..v07 one path
    extra = [("v09", "v10")]                          # v09-v10; v08 and v11 alone
    v = spark.createDataFrame([(i,) for i in ids], "id string")
    e = spark.createDataFrame(chain + extra, "src string, dst string")
    got = {r.id: r.component for r in mt.connected_components(v, e).collect()}
    assert all(got[i] == "v00" for i in ids[:8])
    assert got["v09"] == got["v10"] == "v09" and got["v08"] == "v08" and got["v11"] == "v11"
