import json

import pytest
from pyspark.sql import functions as F

from canonix.functions import jsontext, text
from canonix.model import testdata_map
from canonix.operators.annotate import annotate
from canonix.plans.steps import StepEnv, run_steps
from conftest import SF

# (input, accepted, final text) following the reference retry rule
CASES = [
    ('```json\n{"a":1}\n```', True, '{"a":1}'),
    ('{"k": 87', True, '{"k": 87}'),
    ('[{"a":1}', True, '[{"a":1}]'),
    ('{"k": "ab', False, None),
    ('[1, 2', False, None),
    ('{', False, None),
    ('{"a":1,', False, None),
    ('{"a":1} x', False, None),
    ("", False, None),
]


def test_repair_rule(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    acc, quar = jsontext.parse_repair(df, "raw")
    got = {r.i: r.json_text for r in acc.collect()}
    for i, (_, ok, final) in enumerate(CASES):
        assert (i in got) == ok, CASES[i]
        if ok:
            assert got[i] == final
    assert quar.count() == sum(1 for c in CASES if not c[1])


def test_fence_and_slice(spark):
    df = spark.createDataFrame([("x ```json\n[1]\n``` ",), ("plan: [[1,2],[3]] done",), ("none",)], "s string")
    out = df.select(jsontext.strip_fences("s").alias("f"), jsontext.array_slice(F.col("s")).alias("a")).collect()
    assert out[0].f == "x \n[1]" and out[1].a == "[[1,2],[3]]" and out[2].a is None


def test_path_helpers(spark):
    df = spark.createDataFrame([("/a/b/c.tar.gz",), ("/x/.env",), ("noext",)], "p string")
    got = df.select(text.file_name("p").alias("f"), text.base_name("p").alias("b"),
                    text.extension("p").alias("e")).collect()
    assert [tuple(r) for r in got] == [("c.tar.gz", "c.tar", ".gz"), (".env", ".env", ""), ("noext", "noext", "")]
    parts = spark.createDataFrame([(" a , b,c ",)], "s string").select(text.split_trim(F.col("s")).alias("p"))
    assert parts.collect()[0].p == ["a", "b", "c"]


def _env(spark):
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem")}
    return StepEnv(spark, testdata_map(), ds, folder=SF)


def test_steps_placeholders(spark):
    spec = [
        {"function": "merge_datasets_by_canonical_key",
         "args": {"harmonization_map": "_harmonization_map_", "data_folder_path": "_data_folder_path_",
                  "merge_key_canonical_name": "order_key"}, "output_variable": "m"},
        {"function": "filter", "args": {"df": "_m_", "canonical_feature_name": "order_key", "value": "201"},
         "output_variable": "f"},
        {"function": "unique_values_df", "args": {"df": "_current_df_", "canonical_feature_name": "order_key"}},
    ]
    out = run_steps(json.dumps(spec), _env(spark))
    assert [r.order_key for r in out.collect()] == [201]
    with pytest.raises(KeyError):
        run_steps([{"function": "filter", "args": {"df": "_nothing_", "canonical_feature_name": "x", "value": "1"}}],
                  _env(spark))
    with pytest.raises(KeyError):
        run_steps([{"function": "os.system", "args": {}}], _env(spark))


def test_annotate_fallback(spark):
    df = spark.createDataFrame([(1, "en"), (2, "fr"), (3, "en")], "i int, lang string")

    def primary(s):
        return [f"P{v}" if v == "en" else None for v in s]

    def broken(s):
        raise RuntimeError("down")

    def backup(s):
        return [f"B{v}" for v in s]

    out = {r.i: (r.result, r.provider) for r in annotate(df, "lang", [("p", primary), ("x", broken),
                                                                      ("b", backup)]).collect()}
    assert out == {1: ("Pen", "p"), 2: ("Bfr", "b"), 3: ("Pen", "p")}


def test_actions_require_arguments(spark):
    from canonix.plans.actions import run_action

    env = _env(spark)
    with pytest.raises(ValueError):
        run_action("unique_values", env.hmap, env.datasets)
    with pytest.raises(ValueError):
        run_action("filter", env.hmap, env.datasets, canonical_feature="status")
    with pytest.raises(ValueError):
        run_action("drop_everything", env.hmap, env.datasets)
    got = run_action("filter", env.hmap, env.datasets, canonical_feature="order_key", filter_value="201",
                     key="order_key", order=["orders.parquet", "lineitem.parquet"])
    assert got.count() == 7
    assert run_action("unique_values", env.hmap, env.datasets, canonical_feature="status").count() == 3


def test_cli_merge_filter_and_generated_map(spark, tmpdir_path, capsys):
    from canonix.__main__ import main

    d = tmpdir_path
    spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, name string").write.option("header", True).csv(
        f"{d}/data/a.csv")
    spark.createDataFrame([(1, "p"), (3, "q")], "id bigint, name string").write.option("header", True).csv(
        f"{d}/data/b.csv")
    # no map yet: it is generated from the folder, then the merge runs on the matched key
    assert main([f"{d}/map.json", f"{d}/data", "--action", "merge", "--canonical_feature", "id"]) == 0
    out = capsys.readouterr().out
    assert "shape: (3, 3)" in out
    assert main([f"{d}/map.json", f"{d}/data", "--action", "unique_values", "--canonical_feature", "name",
                 "--output", f"{d}/names"]) == 0
    assert sorted(r.value for r in spark.read.text(f"{d}/names").collect()) == ["p", "q", "x", "y"]


def test_cli_analyze_writes_map(spark, tmpdir_path, capsys):
    from canonix.__main__ import main
    from canonix.plans.workflow import load_map_from_report_folder

    d = tmpdir_path
    spark.createDataFrame([(1, "x")], "id bigint, name string").write.option("header", True).csv(f"{d}/data/a.csv")
    spark.createDataFrame([(1, "p")], "id bigint, label string").write.option("header", True).csv(f"{d}/data/b.csv")
    assert main([f"{d}/out/map.json", f"{d}/data", "--action", "analyze"]) == 0
    out = capsys.readouterr().out
    assert "- a.csv: Shape [1, 2]" in out
    hm = load_map_from_report_folder(spark, f"{d}/out/map.json")
    assert hm.feature("id").candidates("b.csv") == ["id"]


def test_repair_runs_without_python_and_survives_odd_input(spark):
    odd = ["[" + "9" * 5000 + "]", "[" * 5000, '[{', '{"a":{"b":1', None, '[{"a":1']
    df = spark.createDataFrame(list(enumerate(odd)), "i int, raw string")
    out = jsontext.parse_repair_all(df, "raw")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.i: (r.accepted, r.json_text) for r in out.collect()}
    assert got[5] == (True, '[{"a":1}]')
    assert not any(got[i][0] for i in (1, 2, 3, 4))
