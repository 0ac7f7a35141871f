import pytest
from pyspark.sql import functions as F

from canonix.model import HarmonizationMap, testdata_map
from canonix.operators.values import (consolidate_values, distinct_consolidate, unique_values_across,
                                      unique_values_df, unique_values_single)
from conftest import SF

M = HarmonizationMap.from_obj([
    {"canonical_name": "k", "data_type": "Integer", "original_columns": {"a.csv": ["ka"], "b.csv": ["kb"]}},
])


def test_unique_across_sorted_text_and_nulls(spark):
    ds = {"a.csv": spark.createDataFrame([(3,), (None,), (10,)], "ka int"),
          "b.csv": spark.createDataFrame([(3,), (2,)], "kb bigint"),
          "z.csv": spark.createDataFrame([(99,)], "ka int")}  # not listed for k: ignored
    vals = [r.k for r in unique_values_across(M, ds, "k").collect()]
    assert vals == ["10", "2", "3"]  # text sort, as the reference's sorted(list of str)
    with_null = [r.k for r in unique_values_across(M, ds, "k", include_null=True).collect()]
    assert with_null == [None, "10", "2", "3"]
    with pytest.warns(UserWarning):
        assert unique_values_across(M, ds, "nope", spark=spark).count() == 0


def test_unique_across_sf001(spark):
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "supplier", "nation")}
    assert unique_values_across(testdata_map(), ds, "nation_key").count() == 25


def test_unique_df_and_single(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "x int, y string")
    assert sorted((r.y is None, r.y) for r in unique_values_df(df, "y").collect()) == [(False, "a"), (True, None)]
    with pytest.warns(UserWarning):
        assert unique_values_df(df, "nope").dtypes == [("nope", "string")] and unique_values_df(df, "nope").count() == 0
    got = {r.k for r in unique_values_single(spark.createDataFrame([(1,), (None,)], "ka int"), "a.csv", M,
                                             "k").collect()}
    assert got == {"1", None}


def test_consolidate_twice_equals_once(spark, tmpdir_path):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "CELL_LINE string")
    b = spark.createDataFrame([("y",), ("z",)], "CELL_LINE string")
    c = spark.createDataFrame([("q",)], "OTHER string")
    for name, df in (("a", a), ("b", b), ("c", c)):
        df.write.option("header", True).csv(f"{tmpdir_path}/{name}.csv")
    out = f"{tmpdir_path}/out.csv"
    paths = [f"{tmpdir_path}/{n}.csv" for n in ("a", "b", "c")]
    r1, skipped = distinct_consolidate(spark, paths, "CELL_LINE", out)
    assert [r.CELL_LINE for r in r1.collect()] == ["x", "y", "z"] and skipped == [paths[2]]
    r2, _ = distinct_consolidate(spark, paths, "CELL_LINE", out)
    assert [r.CELL_LINE for r in r2.collect()] == ["x", "y", "z"]
    from canonix.operators.values import read_consolidated_csv

    latest = read_consolidated_csv(spark, out)
    assert [r.CELL_LINE for r in latest.collect()] == ["x", "y", "z"]
    assert read_consolidated_csv(spark, f"{tmpdir_path}/nothing-here") is None
    assert [r.CELL_LINE for r in consolidate_values([a, b, c], "CELL_LINE").collect()] == ["x", "y", "z"]


ODD = ['he said "x"', "two\nlines", "007", "0501", " padded ", "a,b", "plain", "é"]


def _csv(spark, path, values):
    from canonix.sources.sinks import write_csv

    write_csv(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, kind string"), path)
    return path


def test_consolidate_writes_new_values_only_and_keeps_text(spark, tmpdir_path):
    import os

    from canonix.operators.values import read_consolidated_csv

    out = f"{tmpdir_path}/out"
    a, b = _csv(spark, f"{tmpdir_path}/a.csv", ODD[:4]), _csv(spark, f"{tmpdir_path}/b.csv", ODD[2:] + [None])
    r1, _ = distinct_consolidate(spark, [a], "kind", out)
    assert [r.kind for r in r1.collect()] == sorted(ODD[:4])
    r2, _ = distinct_consolidate(spark, [a, b], "kind", out)
    assert [r.kind for r in r2.collect()] == sorted(ODD)
    delta = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/v-1-d-1")
    assert sorted(r.kind for r in delta.collect()) == sorted(ODD[4:])
    r3, _ = distinct_consolidate(spark, [a, b], "kind", out)
    assert [r.kind for r in r3.collect()] == sorted(ODD) and sorted(os.listdir(out)) == ["v-1", "v-1-d-1"]
    c = _csv(spark, f"{tmpdir_path}/c.csv", ["new"])
    r4, _ = distinct_consolidate(spark, [c], "kind", out, merge_every=2)  # a new base in place of the second delta
    assert [r.kind for r in r4.collect()] == sorted([*ODD, "new"]) and "v-2" in os.listdir(out)
    os.makedirs(f"{out}/v-3")  # a run that died
    assert sorted(r.kind for r in read_consolidated_csv(spark, out).collect()) == sorted([*ODD, "new"])


def test_stream_starts_from_the_stored_result(spark, tmpdir_path):
    import os

    from canonix.streaming.consolidate import consolidate_stream, read_consolidated

    out = f"{tmpdir_path}/out"
    _csv(spark, f"{tmpdir_path}/in/a", ODD[:5])
    consolidate_stream(spark, f"{tmpdir_path}/in/*", "kind", out, f"{tmpdir_path}/c1")
    assert [r.kind for r in read_consolidated(spark, out, "kind").collect()] == sorted(ODD[:5])
    _csv(spark, f"{tmpdir_path}/in/b", ODD[3:])
    with open(f"{tmpdir_path}/in/other.csv", "w") as f:
        f.write("kind,n\nother order,1\n")
    consolidate_stream(spark, f"{tmpdir_path}/in/*", "kind", out, f"{tmpdir_path}/c2", files_per_batch=1)  # a new checkpoint
    got = [r.kind for r in read_consolidated(spark, out, "kind").collect()]
    assert got == sorted([*ODD, "other order"])
    before = sorted(os.listdir(out))
    consolidate_stream(spark, f"{tmpdir_path}/in/*", "kind", out, f"{tmpdir_path}/c2")  # nothing is new
    assert sorted(os.listdir(out)) == before
    assert read_consolidated(spark, f"{tmpdir_path}/none", "kind").count() == 0


def test_dates_and_text_meet_as_text(spark):
    import datetime as dt

    from canonix.operators.merge import merge_by_key
    from canonix.operators.standardize import standardize_all

    m = HarmonizationMap.from_obj([
        {"canonical_name": "day", "data_type": "String", "original_columns": {"a": ["d"], "b": ["d"]}},
        {"canonical_name": "n", "data_type": "Integer", "original_columns": {"a": ["n"], "b": ["n"]}}])
    day = dt.date(2024, 1, 5)
    a = spark.createDataFrame([(day, 1), (None, 2)], "d date, n int")
    b = spark.createDataFrame([("2024-01-05", day), ("Jan 5 2024", day), ("unknown", day)], "d string, n date")
    std = standardize_all({"a": a, "b": b}, m)
    assert [r.day for r in std["b"].collect()] == ["2024-01-05", "Jan 5 2024", "unknown"]
    assert dict(std["a"].dtypes) == dict(std["b"].dtypes) == {"day": "string", "n": "bigint"}
    got = {(r.day, r.n) for r in merge_by_key(m, {"a": a, "b": b}, "day").collect()}
    assert got == {("2024-01-05", 1), ("Jan 5 2024", None), ("unknown", None), (None, 2)}
    both = standardize_all({"a": a.drop("n"), "b": b.select(b.n.alias("d"))}, m)
    assert dict(both["a"].dtypes)["day"] == "date"
