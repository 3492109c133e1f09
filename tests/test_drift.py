import itertools
import json
import random

from cairnflow.operators import drift


def test_assignment_is_minimal():
    rnd = random.Random(1)
    for n in range(1, 6):
        cost = [[rnd.random() for _ in range(n)] for _ in range(n)]
        got = drift.assignment(cost)
        assert sorted(got) == list(range(n))
        least = min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
        assert abs(sum(cost[i][got[i]] for i in range(n)) - least) < 1e-9


def test_edit_script_renames_moves_and_retypes():
    leaf = lambda k: {"kind": k, "children": {}}
    old = {"a": leaf("number"), "b": leaf("string"), "c": {"kind": "object", "children": {"x": leaf("string")}}}
    new = {"a": leaf("string"), "bb": leaf("string"), "c": {"kind": "object", "children": {}}, "y": leaf("string")}
    like = {("b", "bb"), ("c.x", "y")}
    _, script = drift.edit_script(old, new, lambda p, q: 0.0 if (p, q) in like else 1.0)
    assert set(script) == {("retype", "a", "string"), ("rename", "b", "bb"), ("move", "c.x", "y")}
    assert drift.edit_script({}, {}, lambda p, q: 1.0) == (0.0, [])


def records(spark, files):
    rows = []
    for feed, seq, recs in files:
        rows += [(feed, seq, hash_id(feed, seq), p if isinstance(p, str) or p is None else json.dumps(p), "clash") for p in recs]
    return spark.createDataFrame(rows, "feed_id string, file_seq int, file_id long, payload string, field string")


def hash_id(feed, seq):
    return ord(feed) * 100 + seq


def changes(spark, files):
    df = records(spark, files)
    values = drift.field_values(df.drop("field"), "payload", ["feed_id", "file_seq", "file_id"])
    scripts = drift.feed_scripts(values, df)
    return df, scripts, drift.schema_changes(scripts)


def test_changes_per_file(spark):
    base = [{"CIK": 100 + i, "name": f"firm {i}", "flag": True, "at": f"2024-01-0{i + 1}T00:00:00Z"} for i in range(5)]
    second = [{"company_cik": r["CIK"], "Name": r["name"], "flag": "Y", "at": {"value": r["at"]}, "extra": None} for r in base[2:]] + [{"company_cik": 900, "Name": "firm 9"}]
    third = [{"company_cik": str(r["company_cik"]), "at": r.get("at"), "flag": r.get("flag")} for r in second[1:]] + ["not json", None, "[1]"]
    _, _, c = changes(spark, [("a", 1, base), ("a", 2, second + second), ("a", 3, third), ("b", 1, base), ("c", 4, [])])
    got = {(r.feed_id, r.file_seq, r.field_name, r.change_kind, r.new_name) for r in c.collect()}
    assert got == {("a", 2, "cik", "renamed", "company_cik"), ("a", 2, "flag", "retyped", ""), ("a", 2, "at", "retyped", ""), ("a", 2, "extra", "added", ""), ("a", 3, "company_cik", "retyped", ""), ("a", 3, "name", "removed", ""), ("a", 3, "extra", "removed", "")}


def test_one_table_out_of_all_files(spark):
    base = [{"cik": 100 + i, "at": f"2024-01-0{i + 1}T00:00:00Z"} for i in range(4)]
    df, scripts, _ = changes(spark, [("a", 1, base), ("a", 2, [{"Company_CIK": str(r["cik"]), "at": [r["at"]]} for r in base])])
    plan = drift.projections(scripts, ["cik", "at"])
    got = drift.read_as_one(df, "payload", plan, {"cik": "bigint", "at": "timestamp"}, ["file_seq"])
    assert sorted((r.file_seq, r.cik, r["at"].day) for r in got.collect()) == [(f, 100 + i, i + 1) for f in (1, 2) for i in range(4)]


def test_no_records(spark):
    _, _, c = changes(spark, [("a", 1, [None])])
    assert c.count() == 0


def test_schema_texts_are_trees():
    got = drift.parse_schema("OBJECT<a: STRING, `b c`: ARRAY<OBJECT<x: DECIMAL(3,1), y: VOID>>, d: OBJECT<e: BIGINT>>")
    leaf = lambda k: {"kind": k, "children": {}}
    assert got == {"a": leaf("string"), "b c": {"kind": "array", "children": {"[]": {"kind": "object", "children": {"x": leaf("number"), "y": leaf(None)}}}}, "d": {"kind": "object", "children": {"e": leaf("number")}}}


def test_nested_members_and_moves(spark):
    """Members of an object are added, removed and renamed by path; a field that goes into an object is followed there."""
    one = [{"id": i, "cik": 100 + i, "place": {"street": f"s{i}", "zip": i}, "geo": {"lat": 1.5}} for i in range(4)]
    two = [{"id": i, "place": {"street_1": f"s{i}", "zip": str(i), "cik": 100 + i}, "geo": {"lat": 1.5, "lon": 2.5}} for i in range(4)]
    df, scripts, c = changes(spark, [("a", 1, one), ("a", 2, two), ("a", 3, two)])
    got = {(r.file_seq, r.field_name, r.change_kind, r.new_name, r.level) for r in c.collect()}
    assert got == {(2, "cik", "removed", "", 1), (2, "cik", "moved", "place.cik", 2), (2, "place.street", "renamed", "place.street_1", 2), (2, "place.zip", "retyped", "", 2), (2, "geo.lon", "added", "", 2)}
    rows = drift.read_as_one(df, "payload", drift.projections(scripts, ["id", "cik"]), {"id": "bigint", "cik": "bigint"}, ["file_seq"]).collect()
    assert {(r.file_seq, r.id, r.cik) for r in rows} == {(f, i, 100 + i) for f in (1, 2, 3) for i in range(4)}
