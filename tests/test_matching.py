"""Column matching: candidates against all pairs, one-to-one assignment, groups that keep qualifiers apart, value evidence."""

import itertools
import random

import pytest

from canonix.operators import match as mt
from canonix.plans.workflow import analyze_folder, ensure_map


def _groups(datasets, **cfg):
    out = {}
    for r in mt.match_columns(datasets, mt.MatchConfig(**cfg)).collect():
        out.setdefault(r.canonical_name, set()).add((r.dataset, r.column_name))
    return out


def test_qualifiers_stay_apart(spark):
    ds = {"x.csv": spark.createDataFrame([(1.0, "p")], "YIELD double, key string"),
          "y.csv": spark.createDataFrame([(1.5, "q")], "NORTH_YIELD double, key string"),
          "z.csv": spark.createDataFrame([(2.5, 3.5)], "SOUTH_YIELD double, SOUTH_RAIN double")}
    groups = _groups(ds)
    assert not any({("y.csv", "NORTH_YIELD"), ("z.csv", "SOUTH_YIELD")} <= g for g in groups.values())
    assert {("x.csv", "key"), ("y.csv", "key")} in groups.values()
    # the plain name goes with one of them, not with both
    assert sum(("x.csv", "YIELD") in g and len(g) == 2 for g in groups.values()) == 1


def test_one_partner_a_dataset_and_no_two_columns_of_one(spark):
    a = spark.createDataFrame([(1, 1)], "drug_id int, drug int")
    b = spark.createDataFrame([(1, 1)], "drug_id int, drug_code int")
    c = spark.createDataFrame([(1,)], "drug int")
    groups = _groups({"a.csv": a, "b.csv": b, "c.csv": c})
    assert {("a.csv", "drug_id"), ("b.csv", "drug_id")} in groups.values()
    for g in groups.values():
        assert len({d for d, _ in g}) == len(g)


def test_types_meet_by_equal_names(spark):
    import datetime as dt

    day = dt.date(2024, 1, 5)
    a = spark.createDataFrame([(1, "7", day)], "amount int, code string, day date")
    b = spark.createDataFrame([(1.5, 7, day)], "amount double, code int, day date")
    rows = mt.match_columns({"a.csv": a, "b.csv": b}).collect()
    kinds = {r.canonical_name: r.data_type for r in rows}
    assert kinds == {"amount": "Float", "code": "String", "day": "String"} and len(rows) == 6


def test_a_single_shared_value_is_evidence(spark):
    a = spark.createDataFrame([("metric",), ("metric",)], "unit string")
    b = spark.createDataFrame([("metric", 1)], "measure string, n int")
    assert {("a.csv", "unit"), ("b.csv", "measure")} in _groups({"a.csv": a, "b.csv": b}).values()


def test_sketches_keep_every_contained_pair(spark):
    many = spark.range(60_000).selectExpr("concat('v', id) AS a", "concat('w', id) AS b")
    few = spark.range(900).selectExpr("concat('v', id * 60) AS c", "concat('u', id) AS d", "if(id < 730, concat('w', id * 7), concat('t', id)) AS e")
    ds = {"m.csv": many, "f.csv": few}
    cfg = mt.MatchConfig(sketch_bits=8)
    likely = {tuple(sorted(x.split("\u0001")[1] for x in p)) for p in mt.sketch_pairs(ds, mt.column_catalog(spark, ds), cfg)}
    assert {("a", "c"), ("b", "e")} <= likely
    same = {"p.csv": spark.range(5000).selectExpr("concat('v', id) AS a"), "q.csv": spark.range(5000).selectExpr("concat('x', id) AS b")}
    assert mt.sketch_pairs(same, mt.column_catalog(spark, same), mt.MatchConfig()) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_name_candidates_lose_no_pair(spark, seed):
    rnd = random.Random(seed)
    words = ["id", "id", "name", "name", "name", "field", "plot", "line", "rain", "unit", "soil", "crop", "yield", "area"]
    tables = {f"t{i}.csv": list(dict.fromkeys("_".join(rnd.sample(words, rnd.randint(1, 4))) + rnd.choice(["", "", "x"]) for _ in range(9))) for i in range(5)}
    ds = {n: spark.createDataFrame([tuple(range(len(c)))], ", ".join(f"{x} int" for x in c)) for n, c in tables.items()}
    cat = mt.column_catalog(spark, ds)
    got = {(r.col_a, r.col_b): round(r.name_score, 9) for r in mt.name_pairs(cat).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = list(itertools.accumulate(zip(row, row[1:], b), lambda left, c: min(left + 1, c[1] + 1, c[0] + (x != c[2])), initial=i))
        return row[-1]

    want = {}
    rows = cat.collect()
    for a, b in itertools.product(rows, rows):
        if a.dataset >= b.dataset or mt._apart(a.tokens, b.tokens):
            continue
        ta, tb = set(a.tokens), set(b.tokens)
        ca, cb = a.name_key.replace("_", ""), b.name_key.replace("_", "")
        edit = 1 - distance(ca, cb) / max(len(ca), len(cb))
        score = max(len(ta & tb) / len(ta | tb), edit if edit >= 0.85 else 0)
        if score >= 0.5:
            want[a.col_id, b.col_id] = round(score, 9)
    assert got == want and len(want) > 20


def test_candidates_of_a_common_token_do_not_all_meet(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("bcdfghjklmnpqrstvwxyz") for _ in range(12))
    ds = {f"t{i}.csv": spark.createDataFrame([(1, 1)], f"{word()}_name int, {word()}_name int") for i in range(20)}
    base = mt.column_catalog(spark, ds).selectExpr("col_id AS id", "dataset", "tokens", "replace(name_key, '_', '') AS compact")
    assert mt.name_candidates(base, 0.5, 0.85).count() < 20


def test_map_that_is_none(spark, tmpdir_path):
    from canonix.model import MapLoadError

    with open(f"{tmpdir_path}/map.json", "w") as f:
        f.write("not a map")
    ds = {"a.csv": spark.createDataFrame([(1, "x")], "id int, name string"), "b.csv": spark.createDataFrame([(1, "y")], "id int, name string")}
    with pytest.raises(MapLoadError, match="no valid map"):
        ensure_map(spark, ds, f"{tmpdir_path}/map.json")
    made = ensure_map(spark, ds, f"{tmpdir_path}/map.json", replace_invalid=True)
    assert made.feature_names == ["id", "name"] and [c.data_type for c in made.feature("id").original_columns["a.csv"]] == ["Integer"]


def test_folder_analysis_keeps_samples_and_sidecars(spark, tmpdir_path):
    import json

    with open(f"{tmpdir_path}/a.csv", "w") as f:
        f.write(" id ,v\n" + "".join(f"{9 - i},{'NA' if i == 1 else i}\n" for i in range(8)))
    with open(f"{tmpdir_path}/a.md", "w") as f:
        f.write("about a")
    found, skipped = analyze_folder(spark, tmpdir_path)
    prof = found.dataset_profile.collect()[0]
    assert (prof["rows"], prof["cols"], prof["metadata"]) == (8, 2, "about a")
    assert [r["id"] for r in json.loads(prof["sample_json"])] == [9, 8, 7, 6, 5]
    cols = {r.column_name: (r.null_count, r.unique_sample) for r in found.column_profile.collect()}
    assert cols == {"id": (0, ["9", "8", "7", "6", "5"]), "v": (1, ["0", None, "2", "3", "4"])}
    assert skipped == [("a.md", "unsupported extension .md")]
