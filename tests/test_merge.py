import random

import pytest
from pyspark.sql import functions as F

from canonix.model import HarmonizationMap, testdata_map
from canonix.operators.merge import SkewConfig, _renamed_parts, _salted_branch, find_hot_keys, merge_by_key, merge_row_count, participants
from conftest import SF, rows

MAP = HarmonizationMap.from_obj([
    {"canonical_name": "k", "data_type": "Integer",
     "original_columns": {"a.csv": ["ka"], "b.csv": ["kb"], "c.csv": ["kc"]}},
    {"canonical_name": "v", "data_type": "String",
     "original_columns": {"a.csv": ["va"], "b.csv": ["vb"], "c.csv": ["vc"]}},
    {"canonical_name": "w", "data_type": "Float", "original_columns": {"b.csv": ["wb"], "d.csv": ["wd"]}},
])


def _rand_tables(spark, seed, n=40, keys=6):
    rnd = random.Random(seed)

    def t(kcol, vcol, extra=None):
        data = []
        for i in range(rnd.randint(0, n)):
            k = rnd.choice([None] + list(range(keys)))
            row = [k, f"{vcol}{i}"]
            if extra:
                row.append(float(i))
            data.append(tuple(row))
        schema = f"{kcol} int, {vcol} string" + (f", {extra} double" if extra else "")
        return spark.createDataFrame(data, schema)

    return {"a.csv": t("ka", "va"), "b.csv": t("kb", "vb", "wb"), "c.csv": t("kc", "vc"),
            "d.csv": spark.createDataFrame([(1.0,), (2.0,)], "wd double")}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spine_equals_chain_with_nulls_and_duplicates(spark, seed):
    ds = _rand_tables(spark, seed)
    spine = merge_by_key(MAP, ds, "k")
    chain = merge_by_key(MAP, ds, "k", strategy="chain")
    assert spine.columns == chain.columns
    assert rows(spine) == rows(chain)


@pytest.mark.parametrize("seed", [21, 22])
@pytest.mark.parametrize("skew", [SkewConfig(), SkewConfig(input_rows=3, output_rows=5)])
def test_layout_equals_chain(spark, seed, skew):
    ds = _rand_tables(spark, seed)
    for options in ({"include_unkeyed": True}, {"prune_null": True, "key_filter": F.col("k") < 3}):
        want = merge_by_key(MAP, ds, "k", strategy="chain", **options)
        got = merge_by_key(MAP, ds, "k", strategy="layout", skew=skew, **options)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_layout_scans_each_file_once_and_exchanges_keys_only(spark, tmpdir_path, monkeypatch):
    from canonix.operators import merge as mg
    from canonix.sources import tables

    for name, col in (("a", "ka,va"), ("b", "kb,vb,wb"), ("c", "kc,vc")):
        with open(f"{tmpdir_path}/{name}.csv", "w") as f:
            f.write(col + "\n" + "".join(f"{i % 7},x{i}{',1.5' if name == 'b' else ''}\n" for i in range(40)))
    loaded, _ = tables.load_folder(spark, tmpdir_path, hmap=MAP)
    scans, written = [], mg._written
    monkeypatch.setattr(mg, "_written", lambda df, name: scans.append(df._jdf.queryExecution().toString().count("Scan csv")) or written(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_by_key(MAP, loaded, "k", strategy="layout")
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(map(bool, scans)) == 3 and "Scan csv" not in plan
    # At most the distinct keys are exchanged; the three bucketed sides are joined as they are.
    assert plan.count("Exchange hashpartitioning") <= 1 and plan.count("SortMergeJoin") == 3 and plan.count("Bucketed: true") >= 3
    assert rows(merged) == rows(merge_by_key(MAP, loaded, "k", strategy="chain"))


@pytest.mark.parametrize("seed", [4, 5])
def test_salted_hot_keys_equal_plain(spark, seed):
    ds = _rand_tables(spark, seed, n=60, keys=3)
    plain = merge_by_key(MAP, ds, "k", skew=SkewConfig(enabled=False))
    salted = merge_by_key(MAP, ds, "k", skew=SkewConfig(input_rows=2, output_rows=3))
    assert rows(plain) == rows(salted)


def test_every_key_hot_after_a_shuffle(spark):
    a = spark.range(600).selectExpr("id % 200 AS k", "id AS x").repartition(5)
    b = spark.range(400).selectExpr("id % 200 AS k", "id AS y").repartition(3)
    parts = [a, b]
    hot = find_hot_keys(parts, "k", SkewConfig(input_rows=1, output_rows=2))
    assert hot.count() == 200 and hot.agg({"n0": "sum"}).first()[0] == 600
    got = sorted(map(tuple, _salted_branch(parts, "k", hot, SkewConfig(input_rows=1, output_rows=2)).select("k", "x", "y").collect()))
    assert got == sorted(map(tuple, a.join(b, "k").select("k", "x", "y").collect()))
    assert find_hot_keys(parts, "k", SkewConfig()) is None


def test_exact_copies_split_by_salt(spark):
    # one key holding many identical rows: the row ids keep copies apart
    a = spark.createDataFrame([(1, "x")] * 50 + [(2, "y")], "ka int, va string")
    b = spark.createDataFrame([(1, "p")] * 7 + [(3, "q")], "kb int, vb string")
    ds = {"a.csv": a, "b.csv": b}
    salted = merge_by_key(MAP, ds, "k", skew=SkewConfig(input_rows=4, output_rows=10))
    plain = merge_by_key(MAP, ds, "k", skew=SkewConfig(enabled=False))
    assert salted.count() == 50 * 7 + 1 + 1
    assert rows(salted) == rows(plain)


def test_suffix_names_and_skip_unkeyed(spark):
    ds = _rand_tables(spark, 7)
    names, skipped = participants(MAP, ds, "k")
    assert names == ["a.csv", "b.csv", "c.csv"] and skipped == ["d.csv"]
    m = merge_by_key(MAP, ds, "k")
    assert m.columns == ["k", "v", "w", "v_from_b_csv", "w_from_b_csv", "v_from_c_csv", "w_from_c_csv"]
    pruned = merge_by_key(MAP, ds, "k", prune_null=True)
    assert pruned.columns == ["k", "v", "v_from_b_csv", "w_from_b_csv", "v_from_c_csv"]


def test_include_unkeyed_appends_rows(spark):
    ds = _rand_tables(spark, 8)
    base = merge_by_key(MAP, ds, "k").count()
    withd = merge_by_key(MAP, ds, "k", include_unkeyed=True)
    assert withd.count() == base + 2
    assert withd.where(F.col("w_from_d_csv").isNotNull()).count() == 2


def test_unknown_key_raises(spark):
    with pytest.raises(KeyError):
        merge_by_key(MAP, _rand_tables(spark, 9), "nope")


def test_row_count_guard_matches(spark):
    ds = _rand_tables(spark, 10)
    parts, _ = _renamed_parts(MAP, ds, ["a.csv", "b.csv", "c.csv"], "k", False)
    assert merge_row_count(parts, "k").collect()[0]["rows"] == merge_by_key(MAP, ds, "k").count()


def test_known_answers_sf001(spark):
    hm = testdata_map()
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "supplier", "nation")}
    m = merge_by_key(hm, ds, "nation_key", order=["customer.parquet", "supplier.parquet", "nation.parquet"])
    r = m.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("account_balance"), 2).alias("c"),
              F.round(F.sum("account_balance_from_supplier_parquet"), 2).alias("s")).collect()[0]
    assert (r.n, r.c, r.s) == (5949, 27079805.67, 26978213.86)
    ol = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem")}
    assert merge_by_key(hm, ol, "order_key", order=["orders.parquet", "lineitem.parquet"]).count() == 60257


@pytest.mark.parametrize("strategy", ["chain", "spine"])
def test_key_filter_reaches_every_scan(spark, strategy):
    from canonix.operators.filters import merge_then_filter

    hm = testdata_map()
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem")}
    m = merge_then_filter(hm, ds, "order_key", "201", key="order_key", order=["orders.parquet", "lineitem.parquet"],
                          strategy=strategy)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,201)" in plan and "EqualTo(l_orderkey,201)" in plan
    if strategy == "spine":
        assert "FullOuter" not in plan
    assert m.count() == 7


def test_user_filter_on_spine_key_reaches_scans(spark):
    from pyspark.sql import functions as F

    hm = testdata_map()
    ds = {f"{t}.parquet": spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "supplier", "nation")}
    m = merge_by_key(hm, ds, "nation_key").where(F.col("nation_key") == 7)
    plan = m._jdf.queryExecution().executedPlan().toString()
    for c in ("c_nationkey", "s_nationkey", "n_nationkey"):
        assert f"EqualTo({c},7)" in plan


@pytest.mark.parametrize("strategy", ["chain", "spine"])
def test_detected_hot_keys_stay_exact(spark, strategy):
    ds = _rand_tables(spark, 11, n=80, keys=3)
    plain = merge_by_key(MAP, ds, "k", strategy=strategy, skew=SkewConfig(enabled=False))
    split = merge_by_key(MAP, ds, "k", strategy=strategy,
                         skew=SkewConfig(input_rows=2, output_rows=3))
    assert rows(plain) == rows(split)


def test_chain_with_salted_hot_keys(spark):
    ds = _rand_tables(spark, 12, n=60, keys=3)
    plain = merge_by_key(MAP, ds, "k", strategy="spine", skew=SkewConfig(enabled=False))
    salted = merge_by_key(MAP, ds, "k", strategy="chain",
                          skew=SkewConfig(input_rows=2, output_rows=3))
    assert rows(plain) == rows(salted)


def test_split_rule_expressions_match_python(spark):
    from pyspark.sql import functions as F

    from canonix.operators.merge import _split, _split_cols

    skew = SkewConfig(input_rows=10, output_rows=50)
    cases = [(1, 0), (1, 5), (1, 100), (30, 7), (500, 500), (3, 2000), (1000, 1)]
    df = spark.createDataFrame(cases, "a bigint, b bigint")
    sa, sb = _split_cols(F.col("a"), F.col("b"), skew)
    got = {(r.a, r.b): (r.sa, r.sb) for r in df.select("a", "b", sa.alias("sa"), sb.alias("sb")).collect()}
    assert got == {c: _split(*c, skew) for c in cases}


@pytest.mark.parametrize("strategy", ["chain", "spine"])
def test_max_rows_guard(spark, strategy):
    from canonix.operators.merge import MergeTooLarge

    ds = _rand_tables(spark, 13)
    n = merge_by_key(MAP, ds, "k", strategy=strategy).count()
    assert merge_by_key(MAP, ds, "k", strategy=strategy, max_rows=n).count() == n
    with pytest.raises(MergeTooLarge):
        merge_by_key(MAP, ds, "k", strategy=strategy, max_rows=n - 1)


def test_mixed_physical_key_types_join_under_ansi(spark):
    m = HarmonizationMap.from_obj([
        {"canonical_name": "k", "data_type": "Integer", "original_columns": {"a.csv": ["ka"], "b.csv": ["kb"]}},
        {"canonical_name": "v", "data_type": "String", "original_columns": {"a.csv": ["va"], "b.csv": ["vb"]}},
    ])
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ka int, va string")
    b = spark.createDataFrame([("1", "p"), ("oops", "q"), ("2.0", "r")], "kb string, vb string")
    for strategy in ("chain", "spine"):
        got = sorted(rows(merge_by_key(m, {"a.csv": a, "b.csv": b}, "k", strategy=strategy)),
                     key=lambda t: (t[0] is None, t))
        # "1" and "2.0" are whole numbers; "oops" is none: a null key, never matched
        assert got == [(1, "x", "p"), (2, "y", "r"), (None, None, "q")]


def test_row_guard_tells_overflow(spark):
    from canonix.operators.merge import MergeTooLarge

    names = [f"{c}.csv" for c in "abcd"]
    m = HarmonizationMap.from_obj([{"canonical_name": "k", "data_type": "Integer", "original_columns": {n: ["k"] for n in names}}])
    ds = {n: spark.range(100_000).selectExpr("1 AS k") for n in names}
    with pytest.raises(MergeTooLarge):
        merge_by_key(m, ds, "k", max_rows=10)


@pytest.mark.parametrize("strategy,unkeyed", [("spine", False), ("spine", True), ("chain", False), ("layout", False)])
def test_keys_of_many_output_rows_are_spread_over_tasks(spark, strategy, unkeyed):
    # Two keys with few rows in and a million rows out each, null keys, and a small third dataset.
    a = spark.range(3001).selectExpr("IF(id = 0, NULL, CAST(id % 2 AS INT)) AS ka", "CAST(id AS STRING) AS va")
    b = spark.range(1402).selectExpr("IF(id < 2, NULL, CAST(id % 2 AS INT)) AS kb", "CAST(id AS STRING) AS vb", "1.5D AS wb")
    c = spark.createDataFrame([(0, "x"), (1, "y"), (9, "z")], "kc int, vc string")
    d = spark.createDataFrame([(7.0,)], "wd double")
    ds = {"a.csv": a, "b.csv": b, "c.csv": c, "d.csv": d}
    merged = merge_by_key(MAP, ds, "k", order=list(ds) if unkeyed else list(ds)[:3], strategy=strategy, include_unkeyed=unkeyed)
    tasks = merged.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("v_from_b_csv").alias("s"), F.count("v_from_c_csv").alias("c")).collect()
    assert sum(t.n for t in tasks) == 2 * 1500 * 700 + 1 + 2 + 1 + unkeyed
    assert sum(t.c for t in tasks) == 2 * 1500 * 700 + 1
    assert sum(t.s or 0 for t in tasks) == 1500 * sum(range(2, 1402)) + 1
    assert max(t.n for t in tasks) < 1_000_000


@pytest.mark.parametrize("strategy", ["spine", "chain", "layout"])
def test_columns_without_a_source_are_in_no_join(spark, strategy, monkeypatch):
    from canonix.operators import merge as mg

    ds = _rand_tables(spark, 14, n=60, keys=3)
    hot_rows, written = [], mg._written
    monkeypatch.setattr(mg, "_written", lambda df, name: (hot_rows.extend(df.columns) if name == "hot-rows" else None) or written(df, name))
    merged = merge_by_key(MAP, ds, "k", order=["a.csv", "b.csv", "c.csv"], strategy=strategy, skew=SkewConfig(input_rows=2, output_rows=3))
    assert "w_from_b_csv" in hot_rows and not {"w", "w_from_c_csv"} & set(hot_rows)
    assert dict(merged.dtypes)["w"] == "double" and merged.where("w IS NOT NULL OR w_from_c_csv IS NOT NULL").isEmpty()


def test_a_last_join_of_billions_of_rows_has_tasks_of_millions(spark):
    """25 keys of 216,000, 14,400 and 1 rows, as at 360 times sf0.1: 78 billion rows out, dealt by cells."""
    from pyspark.sql import functions as F

    from canonix.operators import merge as M

    hot = spark.range(25).select(F.col("id").alias("k"), *[F.lit(n).cast("long").alias(f"n{i}") for i, n in enumerate((216_000, 14_400, 1))])
    steps, tasks = M._hot_steps(hot, 3, SkewConfig())
    assert [i for i, _, _ in steps] == [2, 1, 0]
    _, a, b = steps[-1]
    sa, sb = M._cells(a, b, SkewConfig())
    cells = hot.select("k", (a * b / sa / sb).alias("out"), sb.alias("sb"), F.explode(F.sequence(F.lit(0), sa - 1)).alias("i"))
    cells = cells.select("k", "out", "i", F.explode(F.sequence(F.lit(0), F.col("sb") - 1)).alias("j"))
    held = cells.groupBy(F.pmod(F.hash("k", "i", "j"), F.lit(tasks[-1])).alias("task")).agg(F.sum("out").alias("out"))
    most, total = held.agg(F.max("out"), F.sum("out")).first()
    assert round(total) == 25 * 216_000 * 14_400 and most < 5e7


def test_hot_branch_joins_without_an_outer_join(spark):
    """Keys that a dataset lacks keep their rows, the last join builds its rows by an inner join."""
    a = spark.createDataFrame([(k, f"a{k}{i}") for k in (1, 2, 3) for i in range(9)] + [(None, "an")], "ka int, va string")
    b = spark.createDataFrame([(k, f"b{k}{i}", 0.5) for k in (1, 2, 4) for i in range(7)], "kb int, vb string, wb double")
    c = spark.createDataFrame([(1, "c1"), (3, "c3"), (3, "c3"), (5, "c5")], "kc int, vc string")
    ds, skew = {"a.csv": a, "b.csv": b, "c.csv": c}, SkewConfig(input_rows=2, output_rows=5)
    parts, _ = _renamed_parts(MAP, ds, list(ds), "k", True, "not_null")
    branch = _salted_branch(parts, "k", find_hot_keys(parts, "k", skew), skew)
    assert "LeftOuter" not in branch._jdf.queryExecution().optimizedPlan().toString()
    assert {r["k"]: r["n"] for r in branch.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 63, 2: 63, 3: 18, 4: 7}
    for strategy in ("spine", "chain", "layout"):
        plain = merge_by_key(MAP, ds, "k", strategy="spine", skew=SkewConfig(enabled=False))
        assert rows(plain) == rows(merge_by_key(MAP, ds, "k", strategy=strategy, skew=skew))


@pytest.mark.parametrize("strategy", ["spine", "chain", "layout"])
def test_the_hot_branch_leads_the_union(spark, strategy):
    """The plain branch may turn out empty while the merge runs. Were it first, its removal would put a projection
    over the union that writes every row again."""
    ds = _rand_tables(spark, 15, n=60, keys=3)
    merged = merge_by_key(MAP, ds, "k", order=["a.csv", "b.csv", "c.csv"], strategy=strategy, skew=SkewConfig(input_rows=2, output_rows=3))
    first, *others = [x for x in merged._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert "Join Inner" in first and "__sa" in first
    assert any("Join LeftOuter" in x or "Join FullOuter" in x for x in others)
    assert rows(merged) == rows(merge_by_key(MAP, ds, "k", order=["a.csv", "b.csv", "c.csv"], strategy="chain", skew=SkewConfig(enabled=False)))
