from collections import Counter

from pyspark.sql import functions as F

from cairnflow.operators import skew
from cairnflow.operators.ranks import spread_sums


def rows_of(spark):
    rows = [("hot", i, float(i % 7)) for i in range(600)] + [(f"k{i % 90}", i, 1.0) for i in range(300)] + [(None, i, 2.0) for i in range(100)]
    return spark.createDataFrame(rows, "k string, n int, v double"), rows


def test_heavy_keys_are_exact(spark):
    df, rows = rows_of(spark)
    got = {r.k: (r.n_rows, r.total_rows) for r in skew.heavy_keys(df, "k", 0.02).collect()}
    count = Counter(r[0] for r in rows)
    assert got == {k: (n, len(rows)) for k, n in count.items() if k is not None and n >= 0.02 * len(rows)}


def test_heavy_keys_of_nothing(spark):
    assert skew.heavy_keys(spark.createDataFrame([], "k bigint"), "k").count() == 0
    assert skew.heavy_keys(spark.createDataFrame([(None,)], "k bigint"), "k").count() == 0


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([("a",)] * 2 + [(f"x{i}",) for i in range(98)], "k string")
    assert [r.k for r in skew.heavy_keys(df, "k", 0.02).collect()] == ["a"]


def test_aggregate_equals_plain(spark):
    df, _ = rows_of(spark)
    got = {tuple(r) for r in skew.skew_aggregate(df, "k", counts=["v"], sums={"s": F.col("v")}, lasts={"last": F.struct("n", "v")}).select("k", "n_rows", "n_v", "s", "last.n").collect()}
    want = {tuple(r) for r in df.groupBy("k").agg(F.count("*"), F.count("v"), F.sum("v"), F.max("n")).collect()}
    assert got == want


def test_latest_keeps_n_per_key(spark):
    df, rows = rows_of(spark)
    got = skew.skew_latest(df, "k", [F.desc("n"), F.desc("v")], 2).collect()
    assert Counter(r.k for r in got) == Counter({k: min(2, n) for k, n in Counter(r[0] for r in rows).items()})
    assert {r.n for r in got if r.k == "hot"} == {599, 598}


def test_join_equals_plain_even_with_many_heavy_rows(spark):
    df, _ = rows_of(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "k string, w int")
    want = sorted(map(str, df.join(right, "k", "left").collect()))
    assert sorted(map(str, skew.skew_join(df, right, "k", "left").collect())) == want
    assert sorted(map(str, skew.skew_join(df, right, "k", "left", most=1, salts=3).collect())) == want


def test_spread_sums_are_positions(spark):
    df, _ = rows_of(spark)
    for r in spread_sums(df, ["k"], ["n"], salts=5).groupBy("k").agg(F.collect_list("rank").alias("r")).collect():
        assert sorted(r.r) == list(range(len(r.r)))
    sums = spread_sums(df, ["k"], ["n"], F.lit(3).cast("long"), 5, "before").where("k = 'hot'").agg(F.max("before")).first()[0]
    assert sums == 3 * 599
