import os

from pyspark.sql import functions as F

from canonix.sources import listing, sinks, tables, workbooks
from conftest import rows


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_tolerant_and_corrupt_record(spark, tmpdir_path):
    _w(f"{tmpdir_path}/t.csv", "ID,name,val\n1,a,1.5\n2,b,oops\n3,c,2\n")
    df = tables.read_csv(spark, f"{tmpdir_path}/t.csv", "ID bigint, name string, val double", corrupt_column="_bad")
    got = {r.ID: (r.val, r._bad) for r in df.collect()}
    assert got[1] == (1.5, None) and got[2][0] is None and got[2][1] == "2,b,oops" and got[3] == (2.0, None)


def test_csv_na_tokens(spark, tmpdir_path):
    _w(f"{tmpdir_path}/t2.csv", "a,b\nNA,1\nnull,2\nN/A,3\nNone,4\n,5\nx,6\n")
    from pyspark.sql import types as T

    df = tables.read_csv_na_tokens(spark, f"{tmpdir_path}/t2.csv", {"b": T.LongType()},
                                   na_tokens=("", "NA", "null", "N/A", "None"))
    assert [r.a for r in df.orderBy("b").collect()] == [None, None, None, None, None, "x"]
    default = tables.read_csv_na_tokens(spark, f"{tmpdir_path}/t2.csv")
    assert default.where(F.col("a").isNull()).count() == 1


def test_folder_with_a_map_keeps_text(spark, tmpdir_path):
    from canonix.model import HarmonizationMap
    from canonix.operators.standardize import standardize

    _w(f"{tmpdir_path}/m/a.csv", "code,n,day\n007,1.0,2024-01-05\n0501,oops,unknown\n12,3,Jan 5 2024\n")
    hmap = HarmonizationMap.from_obj([
        {"canonical_name": c, "data_type": t, "description": "", "original_columns": {"a.csv": [c]}}
        for c, t in (("code", "String"), ("n", "Integer"), ("day", "String"))])
    loaded, _ = tables.load_folder(spark, f"{tmpdir_path}/m", hmap=hmap)
    got = sorted(map(tuple, standardize(loaded["a.csv"], "a.csv", hmap).select("code", "n", "day").collect()), key=str)
    assert got == [("007", 1, "2024-01-05"), ("0501", None, "unknown"), ("12", 3, "Jan 5 2024")]


def test_inventory_sidecar_precedence_and_load(spark, tmpdir_path):
    d = tmpdir_path
    _w(f"{d}/a.csv", "x\n1\n")
    _w(f"{d}/a.md", "md")
    _w(f"{d}/a.json", "{\"j\": 1}")
    _w(f"{d}/b.CSV", "x\n2\n")
    _w(f"{d}/b.yml", "yml")
    _w(f"{d}/c.csv", "x\n3\n")
    _w(f"{d}/notes.txt", "free text")
    inv = {r.dataset: r.kind for r in listing.folder_inventory(spark, d).collect()}
    assert inv == {"a.csv": "tabular", "b.CSV": "tabular", "c.csv": "tabular", "a.md": "metadata",
                   "a.json": "metadata", "b.yml": "metadata", "notes.txt": "metadata"}
    side = {r.dataset: (r.metadata_file, r.metadata_text) for r in listing.sidecar_pairing(spark, d).collect()}
    assert side == {"a.csv": ("a.json", '{"j": 1}'), "b.CSV": ("b.yml", "yml"), "c.csv": (None, None)}
    loaded, skipped = tables.load_folder(spark, d)
    assert sorted(loaded) == ["a.csv", "b.CSV", "c.csv"]
    assert ("notes.txt", "unsupported extension .txt") in skipped
    sk = {r.dataset: r.reason for r in tables.skipped_frame(spark, skipped).collect()}
    assert sk["notes.txt"] == "unsupported extension .txt"


def test_recursive_discovery_case_sensitive(spark, tmpdir_path):
    d = tmpdir_path
    _w(f"{d}/x/one.csv", "a\n1\n")
    _w(f"{d}/x/y/two.CSV", "a\n2\n")
    _w(f"{d}/z/three.txt", "t")
    got = sorted(r.relative_path for r in listing.recursive_discovery(spark, d, [".csv"]).collect())
    assert got == ["x/one.csv"]
    got_ci = sorted(r.relative_path for r in listing.recursive_discovery(spark, d, [".csv"], True).collect())
    assert got_ci == ["x/one.csv", "x/y/two.CSV"]


def test_workbook_roundtrip(spark, tmpdir_path):
    data = [(1, "a & b", 1.5), (2, "<x>", None), (3, "c", 2.25)]
    blob = workbooks.encode_workbook(["id", "name", "val"], data)
    with open(f"{tmpdir_path}/w1.xlsx", "wb") as f:
        f.write(blob)
    with open(f"{tmpdir_path}/w2.xlsx", "wb") as f:
        f.write(workbooks.encode_workbook(["id", "name"], [(9, "z")]))
    df = workbooks.read_workbook_table(spark, f"{tmpdir_path}/w1.xlsx")
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "val": "double"}
    assert [tuple(r) for r in df.collect()] == data
    both = workbooks.read_workbook_rows(spark, tmpdir_path)
    assert both.select("dataset").distinct().count() == 2
    loaded, _ = tables.load_folder(spark, tmpdir_path)
    assert sorted(loaded) == ["w1.xlsx", "w2.xlsx"]


def test_sinks_roundtrip(spark, tmpdir_path):
    vals = spark.createDataFrame([("a",), ("b",)], "v string")
    sinks.write_text(vals, f"{tmpdir_path}/vals")
    assert sorted(r.value for r in spark.read.text(f"{tmpdir_path}/vals").collect()) == ["a", "b"]
    df = spark.createDataFrame([(1, "x")], "k bigint, s string")
    sinks.write_csv(df, f"{tmpdir_path}/t")
    assert rows(spark.read.option("header", True).schema("k bigint, s string").csv(f"{tmpdir_path}/t")) == [(1, "x")]
    first, shape = sinks.preview(df, 5, ["k"])
    assert shape.collect()[0].asDict() == {"rows": 1, "cols": 2}


def test_csv_header_names_exact_and_standardize(spark, tmpdir_path):
    from canonix.model import HarmonizationMap
    from canonix.operators.standardize import standardize

    _w(f"{tmpdir_path}/t.csv", "ID, name ,id,CCLE IC50 uMol,a.b\n1, x ,10,1.5,p\n2,y,20,bad,q\n")
    df = tables.read_csv(spark, f"{tmpdir_path}/t.csv")
    assert df.columns == ["ID", " name ", "id", "CCLE IC50 uMol", "a.b"]
    hm = HarmonizationMap.from_obj([
        {"canonical_name": "upper", "data_type": "Integer", "original_columns": {"t.csv": ["ID"]}},
        {"canonical_name": "lower", "data_type": "Integer", "original_columns": {"t.csv": ["id"]}},
        {"canonical_name": "ic50", "data_type": "Float", "original_columns": {"t.csv": ["CCLE IC50 uMol"]}},
        {"canonical_name": "dotted", "data_type": "String", "original_columns": {"t.csv": ["a.b"]}},
    ])
    got = sorted(tuple(r) for r in standardize(df, "t.csv", hm).collect())
    assert got == [(1, 10, 1.5, "p"), (2, 20, None, "q")]


def test_csv_quotes_and_line_breaks_roundtrip(spark, tmpdir_path):
    from canonix.sources.sinks import write_csv
    from canonix.sources.tables import read_csv, read_csv_na_tokens

    want = [("1", 'say "hi", ok', "5"), ("2", "two\nlines", "6")]
    write_csv(spark.createDataFrame(want, "id string, txt string, n string"), f"{tmpdir_path}/q")
    for df in (read_csv(spark, f"{tmpdir_path}/q", infer=False), read_csv_na_tokens(spark, f"{tmpdir_path}/q")):
        assert sorted(map(tuple, df.collect())) == want
