import random

from pyspark.sql import functions as F

from cairnflow.operators import diff

SCHEMA = "k string, a string, b string, at int, object_key string"


def brute(left, right):
    def last(rows):
        out = {}
        for k, a, b, at, _ in rows:
            if k is not None and (k not in out or (at, a or "", b or "") > out[k][0]):
                out[k] = ((at, a or "", b or ""), (a, b))
        return {k: v[1] for k, v in out.items()}

    x, y = last(left), last(right)
    found = {(k, "missing_right", "") for k in x.keys() - y.keys()} | {(k, "missing_left", "") for k in y.keys() - x.keys()}
    return found | {(k, "value", f) for k in x.keys() & y.keys() for f, p, q in zip("ab", x[k], y[k]) if p != q}


def test_against_brute_force(spark):
    rnd = random.Random(5)
    pick = lambda: rnd.choice([None, "", "x", "y"])
    make = lambda n: [(rnd.choice([None, *(f"k{i}" for i in range(60))]), pick(), pick(), rnd.randrange(10**6), "clash") for _ in range(n)]
    left, right = make(80), make(80)
    left += left[:20]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = {(r.object_key, r.difference, r.field_name) for r in diff.table_diff(a, b, "k", ["a", "b"], F.col("at"), F.col("at"), bucket_rows=10).collect()}
    assert got == brute(left, right)


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([("k", None, "v" * 50_000, 1, None)] * 3, SCHEMA)
    assert diff.table_diff(empty, empty, "k", ["a", "b"]).count() == 0
    assert [r.difference for r in diff.table_diff(one, empty, "k", ["a", "b"]).collect()] == ["missing_right"]
    assert diff.table_diff(one, one, "k", ["a", "b"]).count() == 0


def test_parity(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "x"), ("2", "x"), ("3", None), (None, "x")], "k string, kind string")
    b = spark.createDataFrame([("1", "x"), ("4", "x")], "k string, kind string")
    got = {r.kind: (r.left_count, r.right_count, r.left_minus_right, r.right_minus_left, r.status) for r in diff.parity(a, b, "k", "kind").collect()}
    assert got == {"x": (2, 2, 1, 1, "fail"), None: (1, 0, 1, 0, "fail")}
