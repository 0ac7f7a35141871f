
from canonix.model import testdata_map
from canonix.operators import profile as pf
from canonix.operators import report as rp
from conftest import SF


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (None, 1.0, "a"), (3, None, "b")], "a int, d double, s string")
    got = {r.column_name: r.null_count for r in pf.null_counts(df, "t").collect()}
    assert got == {"a": 1, "d": 2, "s": 1}
    assert pf.shape(df, "t").collect()[0][1:] == (3, 3)


def test_unique_sample_head_order_of_appearance(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None), (5, "c"), (6, "z")], "i int, s string")
    got = {r.column_name: r["values"] for r in pf.unique_sample_head(df, 5, ["i"]).collect()}
    assert got["s"] == ["b", "a", None, "c"]
    assert got["i"] == ["1", "2", "3", "4", "5"]


def test_unique_sample_full_smallest(spark):
    df = spark.createDataFrame([(i % 7, f"v{i % 3}") for i in range(100)], "i int, s string")
    got = {r.column_name: r["values"] for r in pf.unique_sample_full(df, 5).collect()}
    assert got == {"i": ["0", "1", "2", "3", "4"], "s": ["v0", "v1", "v2"]}


def test_sample_json_records(spark):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    rec = pf.sample_json_records(n, 2, ["n_nationkey"]).collect()[0].records
    assert rec.startswith('[{"n_nationkey":0,') and rec.count("n_nationkey") == 2


def test_report_nests_and_feature_context(spark):
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("region", "nation")}
    cols, dsp = pf.dataset_profile(ds)
    rep = rp.harmonization_report(testdata_map().to_long_df(spark), cols, dsp).collect()[0]
    names = [f.canonical_name for f in rep.harmonization_details]
    assert names == testdata_map().feature_names
    assert rep.dataset_info["nation.parquet"].shape == [25, 3]
    lines = [r.line for r in rp.feature_context(rp.harmonization_report(
        testdata_map().to_long_df(spark), cols, dsp)).orderBy("section", "ord").collect()]
    assert "- nation.parquet: Shape [25, 3]" in lines
    assert "- region_key: Key of a region. (Type: Integer)" in lines
    # datasets the map names but that were not profiled carry no shape
    assert not any("customer.parquet" in x for x in lines)
    assert len(lines) == len(set(lines))


def test_head_without_order_is_file_order(spark):
    import duckdb

    o = spark.read.parquet(f"{SF}/orders.parquet")
    got = [r.o_orderkey for r in pf.head(o, 5).collect()]
    first = [r[0] for r in duckdb.sql(
        f"SELECT o_orderkey FROM read_parquet('{SF}/orders.parquet', file_row_number=true) "
        "ORDER BY file_row_number LIMIT 5").fetchall()]
    assert got == first
    rec = pf.sample_json_records(o, 2).collect()[0].records
    assert rec.startswith('[{"o_orderkey":%d,' % first[0])
    # no file position (local data): ordered by every column
    df = spark.createDataFrame([(2, "b"), (1, "z"), (1, "a")], "i int, s string")
    assert [tuple(r) for r in pf.head(df, 2).collect()] == [(1, "a"), (1, "z")]


def test_full_sample_of_every_kind_of_column(spark):
    import datetime as dt
    from decimal import Decimal

    rows = [(i % 7, float(i % 3) if i % 5 else float("nan"), f"s{i % 11:02d}", dt.date(2024, 1, 1 + i % 4), dt.datetime(2024, 1, 1, i % 3),
             Decimal(i % 2) / 4, i % 2 == 0, [i % 3], bytes([i % 2]), None) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d date, e timestamp_ntz, f decimal(9,2), g boolean, h array<int>, i binary, j int")
    got = {r["column_name"]: (r["position"], r["values"]) for r in pf.unique_sample_full(df, 3, "x").collect()}
    assert got["a"] == (0, ["0", "1", "2"]) and got["b"] == (1, ["0.0", "1.0", "2.0"]) and got["c"] == (2, ["s00", "s01", "s02"])
    assert got["d"][1] == ["2024-01-01", "2024-01-02", "2024-01-03"] and got["e"][1] == [f"2024-01-01 0{h}:00:00" for h in range(3)]
    assert got["f"][1] == ["0.00", "0.25"] and got["g"][1] == ["false", "true"] and got["h"][1] == ["[0]", "[1]", "[2]"]
    assert got["i"][0] == 8 and len(got["i"][1]) == 2 and "j" not in got
    assert pf.unique_sample_full(df.limit(0), 3).count() == 0


def test_profile_scans_each_dataset_once(spark):
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("region", "nation")}
    cols, dsp = pf.dataset_profile(ds, samples=False)
    for frame in (cols, dsp):  # what was found is read again, not the tables
        assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()
