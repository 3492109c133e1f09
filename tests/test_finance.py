import pytest
from pyspark.sql import functions as F

from cairnflow.functions import finance as fin
from cairnflow.operators import finance as fo
from cairnflow.operators import graph, mdm, relations


def one(spark, expression, **values):
    schema = ", ".join(f"{k} double" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("x")).first().x


def test_missing_is_not_zero(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, fin.safe_ratio(a, b), a=1.0, b=0.0) is None and one(spark, fin.safe_ratio(a, b), a=None, b=2.0) is None
    assert one(spark, fin.safe_ratio_signed(a, b), a=1.0, b=-2.0) is None and one(spark, fin.safe_ratio_signed(a, b), a=1.0, b=2.0) == 0.5
    assert one(spark, fin.growth(a, b), a=1.0, b=-2.0) == -1.5
    assert one(spark, fin.cagr(a, b, 3), a=-1.0, b=2.0) is None and one(spark, fin.cagr(a, b, 3), a=8.0, b=1.0) == pytest.approx(1.0)


def test_scores_skip_unknown_terms(spark):
    none = F.lit(None).cast("double")
    terms = {k: none for k in ("dsri", "gmi", "aqi", "sgi", "depi", "sgai", "tata", "lvgi")}
    assert one(spark, fin.manipulation_score(terms | {"sgi": F.col("a")}), a=1.0) is None
    assert one(spark, fin.manipulation_score(terms | {"sgi": F.col("a"), "gmi": F.col("a")}), a=1.0) == pytest.approx(-3.42)
    assert one(spark, fin.distress_score(*(F.col(c) for c in "abcdefg")), a=1.0, b=1.0, c=1.0, d=1.0, e=1.0, f=0.0, g=1.0) is None
    assert one(spark, fin.distress_score(*(F.col(c) for c in "abcdefg")), a=10.0, b=20.0, c=10.0, d=50.0, e=100.0, f=100.0, g=50.0) == pytest.approx(0.12 + 0.28 + 0.33 + 0.6 + 1.0)


def test_gap_gives_null(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("a", 2023, 4.0)], "k string, y int, v double")
    got = {r.y: (r.v_growth, r.v_cagr_3) for r in fo.growth_pack(df, "k", "y", ["v"], (3,)).collect()}
    assert got[2021] == (1.0, None) and got[2023][0] is None and got[2023][1] == pytest.approx(4 ** (1 / 3) - 1)


def test_concepts_by_latest_start_then_preference(spark):
    facts = spark.createDataFrame([("1", "Sales", 5.0, "2023-01-01"), ("1", "Revenues", 9.0, "2023-01-01"), ("1", "Revenues", 3.0, "2023-04-01"), ("1", "Assets", None, None), ("2", "Sales", 7.0, None)], "g string, c string, v double, s string")
    got = {r.g: (r.revenue, r.assets) for r in fo.pick_concepts(facts, ["g"], "c", "v", "s", {"revenue": ["Revenues", "Sales"], "assets": ["Assets"]}).collect()}
    assert got == {"1": (3.0, None), "2": (7.0, None)}


def test_effective_filings(spark):
    rows = [("m", "base", 1, "a"), ("m", "addition", 2, "b"), ("m", "restatement", 3, "c"), ("m", "addition", 4, "d"), ("n", "addition", 1, "e")]
    df = spark.createDataFrame(rows, "k string, kind string, f int, a string")
    assert sorted(r.a for r in fo.effective_filings(df, ["k"], "kind", "f", "a").collect()) == ["c", "d", "e"]
    with pytest.raises(Exception, match="lacks its type"):
        fo.effective_filings(spark.createDataFrame([("m", None, 1, "x")], "k string, kind string, f int, a string"), ["k"], "kind", "f", "a").collect()


def test_survivors(spark):
    rows = [("e", "name", "s1", "Old", 2, None, "2020-01-01"), ("e", "name", "s2", "New", 1, None, "2021-01-01"), ("e", "name", "s3", None, 0, None, "2022-01-01"), ("e", "cik", "s1", "1", 2, None, "2020-01-01"), ("e", "cik", "s2", "2", 1, None, "2021-01-01"), ("e", "state", "s1", "NY", 1, None, "2020-01-01"), ("e", "state", "s9", "DE", 4, None, "2020-01-01")]
    stage = spark.createDataFrame(rows, "entity_id string, field string, source string, value string, priority int, effective_date date, loaded_at string").withColumn("loaded_at", F.to_timestamp("loaded_at"))
    got = mdm.survivors(stage, {"name": "highest_source_rank", "cik": "immutable", "state": "source_priority"}, preferred=("s9",)).first()
    assert (got["name"], got.cik, got.state) == ("New", "1", "DE")


def test_graph_cycles_and_chains(spark):
    merges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("s", "s"), ("n", None)], "o string, n string")
    got = {r.o: r.canonical for r in graph.canonical_ids(merges, "o", "n").collect()}
    assert got == {"a": "d", "b": "d", "c": "d", "x": "x", "y": "y"}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)], "a long, b long")
    parts = {}
    for r in graph.components(edges).collect():
        parts.setdefault(r.component, set()).add(r.node)
    assert parts == {0: set(range(41)), 100: {100, 101, 102}}
    assert graph.components(edges.where("false")).count() == 0
    near = graph.neighbourhood(edges, spark.createDataFrame([(5,)], "node long"), "a", "b", 2)
    assert {(r.node, r.hops) for r in near.collect()} == {(5, 0), (4, 1), (6, 1), (3, 2), (7, 2)}


def test_versions_settle(spark):
    rows = [("r", "2020-01-01", "2021-01-01", 1, "a", "x"), ("r", "2020-06-01", None, 2, "b", "y"), ("q", "2020-01-01", None, 1, "c", "x"), ("q", "2020-01-01", None, 1, "d", "x"), ("q", "2020-02-01", None, 1, "e", "z")]
    df = spark.createDataFrame(rows, "k string, f string, t string, p int, i string, ev string").withColumns({"f": F.to_date("f"), "t": F.to_date("t")})
    got = {r.i: r.state for r in relations.settle_versions(df, "k", "f", "t", "p", ["i"], ["ev"]).collect()}
    assert got == {"a": "current", "b": "superseded", "c": "quarantined", "d": "duplicate", "e": "quarantined"}
