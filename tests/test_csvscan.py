"""The split CSV scan against the standard library's reader, types from the lattice, true heads."""

import csv
import os
import random

import pytest
from pyspark.sql import types as T

from canonix.sources import csvscan, tables
from conftest import rows

SPLIT = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "50"}


@pytest.fixture()
def small_splits(spark):
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k in SPLIT:
        spark.conf.unset(k)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def _cell(rnd):
    return rnd.choice(["plain", "", "a,b", 'say "hi"', "two\nlines", "\n\n\nfour\n", '"\n"', "é\nü", ",\n,", "x" * 40, '\n""",', "end\r\nof line"])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_scan_equals_the_standard_reader(small_splits, tmpdir_path, end):
    rnd = random.Random(end)
    want = []
    for part in range(3):
        data = [[f"{part}-{i}", _cell(rnd), _cell(rnd), f"z{i}"] for i in range(150)]
        with open(f"{tmpdir_path}/p{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", 'a "b"', "c\nd", "last"])
            out.writerows(data)
        want += data
    df = csvscan.text_table(small_splits, tmpdir_path)
    assert df.columns == ["id", 'a "b"', "c\nd", "last"]
    assert csvscan._lines(small_splits, tmpdir_path).rdd.getNumPartitions() > 10
    got = sorted([c or "" for c in r] for r in df.collect())
    assert got == sorted(want)
    assert df.select("last").distinct().count() == 150


def test_quotes_that_open_nothing(small_splits, tmpdir_path):
    text = 'id,size,note\n1,5" pipe,x\n2,3",y\n3,"a ""q"" b",z\n4,"open\nand shut",w\n5,a"b"c,v\n\n6,"tail",u'
    _write(f"{tmpdir_path}/q/t.csv", text + "\n")
    got = {r["id"]: (r["size"], r["note"]) for r in csvscan.text_table(small_splits, f"{tmpdir_path}/q").collect()}
    assert got == {"1": ('5" pipe', "x"), "2": ('3"', "y"), "3": ('a "q" b', "z"), "4": ("open\nand shut", "w"), "5": ('a"b"c', "v"), "6": ("tail", "u")}


def test_unclosed_cell_takes_the_rest_of_its_file_only(small_splits, tmpdir_path):
    _write(f"{tmpdir_path}/u/a.csv", "id,t\n1,x\n2,\"never\n3,shut\n4,x\n")
    _write(f"{tmpdir_path}/u/b.csv", "id,t\n5,y\n6,\"k\nl\"\n")
    got = {r["id"]: r["t"] for r in csvscan.text_table(small_splits, f"{tmpdir_path}/u").collect()}
    assert got.keys() == {"1", "2", "5", "6"} and got["2"].startswith("never\n3,shut\n4,x") and got["6"] == "k\nl"


def test_empty_text_and_null_stay_apart(spark, tmpdir_path):
    _write(f"{tmpdir_path}/e/t.csv", 'a,b\n1,\n2,""\n')
    _write(f"{tmpdir_path}/f/t.csv", 'a,b\n1,\n2,""\n3,"x\ny"\n')
    assert rows(csvscan.text_table(spark, f"{tmpdir_path}/e")) == [("1", None), ("2", "")]
    assert rows(csvscan.text_table(spark, f"{tmpdir_path}/f")) == [("1", None), ("2", ""), ("3", "x\ny")]


def test_headers_bind_by_name(spark, tmpdir_path):
    _write(f"{tmpdir_path}/h/a.csv", "ID,id,\n1,2,3\n")
    df = tables.read_csv_na_tokens(spark, f"{tmpdir_path}/h", {"ID": T.LongType()})
    assert df.columns == ["ID", "id", "_c2"] and [tuple(r) for r in df.collect()] == [(1, "2", "3")]
    _write(f"{tmpdir_path}/g/a.csv", "a,b\n1,x\n")
    _write(f"{tmpdir_path}/g/b.csv", "b,a,c\ny,2,z\n")
    assert rows(tables.read_csv(spark, f"{tmpdir_path}/g", "b string, a bigint")) == [("x", 1), ("y", 2)]
    assert rows(tables.read_csv(spark, f"{tmpdir_path}/g")) == [(1, "x", None), (2, "y", "z")]
    with pytest.warns(UserWarning, match="not in the header"):
        assert rows(tables.read_csv(spark, f"{tmpdir_path}/g/a.csv", "b string, no bigint")) == [("x", None)]


def test_lattice(spark, tmpdir_path):
    lines = ["n,code,day,when,mix,flag,num,wide,late,none,both"]
    for i in range(200):
        lines.append(f"{i},{i:03d},2024-01-{1 + i % 28:02d},2024-01-05 10:{i % 60:02d}:00,{'x' if i % 2 else i},"
                     f"{'TRUE' if i % 3 else 'false'},{i}.5e2,{10 ** 25 + i},{'oops' if i in (150, 151) else i},,{'2024-01-05' if i % 2 else i}")
    _write(f"{tmpdir_path}/l/t.csv", "\n".join(lines) + "\n")
    df = tables.read_csv(spark, f"{tmpdir_path}/l")
    assert dict(df.dtypes) == {"n": "bigint", "code": "string", "day": "date", "when": "timestamp_ntz", "mix": "string", "flag": "boolean",
                               "num": "double", "wide": "decimal(38,0)", "late": "bigint", "none": "string", "both": "string"}
    assert df.filter("late IS NULL").count() == 2 and df.filter("code = '007'").count() == 1
    bad = {"int": 97, "text": 3}
    assert csvscan.joined_type(bad, 0.01) == T.StringType() and csvscan.joined_type(bad, 0.03) == T.LongType()
    assert csvscan.joined_type({"int": 99, "num": 1}, 0.5) == T.DoubleType()
    assert csvscan.joined_type({"int": 9, "code": 1}, 0.5) == T.StringType()
    assert csvscan.joined_type({"date": 5, "time": 1}, 0) == T.TimestampNTZType()


def test_first_rows_are_the_files_first(spark, tmpdir_path):
    _write(f"{tmpdir_path}/z/a.csv", 'v,w\n9,"x\ny"\n8,b\n')
    _write(f"{tmpdir_path}/z/b.csv", "w,v\nc,1\nd,2\n")
    _write(f"{tmpdir_path}/z/c.csv", "broken")
    df = tables.read_csv(spark, f"{tmpdir_path}/z")
    got = csvscan.first_rows(spark, f"{tmpdir_path}/z", 3, df.select("v", "w").schema)
    assert [(r["__pos"], r["v"], r["w"]) for r in got.orderBy("__pos").collect()] == [(1, 9, "x\ny"), (2, 8, "b"), (3, 1, "c")]


def test_empty_files(spark, tmpdir_path):
    _write(f"{tmpdir_path}/n/a.csv", "")
    assert csvscan.text_table(spark, f"{tmpdir_path}/n").count() == 0
    _write(f"{tmpdir_path}/m/a.csv", "a,b\n")
    df = tables.read_csv(spark, f"{tmpdir_path}/m")
    assert df.columns == ["a", "b"] and df.count() == 0


def test_profile_load_strips_names_and_reads_tokens(spark, tmpdir_path):
    _write(f"{tmpdir_path}/p/a.csv", " id ,v\n1,NA\n2,x\n3,n/a\n")
    _write(f"{tmpdir_path}/p/b.csv", "id, id\n1,2\n")
    loaded, skipped = tables.load_folder(spark, f"{tmpdir_path}/p")
    assert rows(loaded["a.csv"]) == [(1, None), (2, "x"), (3, None)] and loaded["a.csv"].columns == ["id", "v"]
    assert [n for n, _ in skipped] == ["b.csv"] and "duplicate" in skipped[0][1]
