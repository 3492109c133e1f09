import itertools
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairnflow.operators import merge
from cairnflow.plans import filings
from cairnflow.streaming import ingest

LOG = [("a", 1, "x", None, 5), ("a", 3, "y", "k", None), ("a", 2, "z", "q", 7), ("b", 1, None, None, None), (None, 9, "n", None, 1)]
SCHEMA = "id string, seq long, name string, note string, n long"


def test_collapse_kinds(spark):
    log = spark.createDataFrame(LOG + LOG, SCHEMA)
    spec = merge.MergeSpec(("id",), first=("name",), coalesce=("n",))
    got = {r.id: (r.seq, r.name, r.note, r.n) for r in merge.collapse(log, spec, "seq").collect()}
    assert got == {"a": (3, "x", "k", 7), "b": (1, None, None, None), None: (9, "n", None, 1)}
    whole = {r.id: r.n for r in merge.collapse(log, merge.MergeSpec(("id",), coalesce=("*",)), "seq").collect()}
    assert whole["a"] == 7
    assert merge.collapse(log.where("false"), spec, "seq").count() == 0


def test_essential_rows_are_enough_in_any_order(spark):
    spec = merge.MergeSpec(("id",), first=("name",), coalesce=("n",))
    want = sorted(map(str, merge.collapse(spark.createDataFrame(LOG, SCHEMA), spec, "seq").collect()))
    for order in itertools.islice(itertools.permutations(LOG), 0, 120, 23):
        state = spark.createDataFrame(order[:2], SCHEMA)
        for row in order[2:]:
            state = merge.essential(state.unionByName(spark.createDataFrame([row, row], SCHEMA)), spec, "seq")
        assert sorted(map(str, merge.collapse(state, spec, "seq").collect())) == want


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(merge.upsert(target, batch, ["k"])) == rows(merge.merge_matched(target, batch, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(merge.upsert(target, batch, ["k"], insert_only=True)) == [(1, "a"), (2, "b"), (3, "C")]


def test_authority(spark):
    spec = merge.MergeSpec(("k",), authority="at", provenance=("run", "mdm_entity_id"))
    schema = "k int, v string, at int, run string, mdm_entity_id string"
    old = spark.createDataFrame([(1, "a", 1, "r1", "m1"), (2, "a", 5, "r1", None), (3, "a", 1, "r1", None), (4, "a", 2, "r1", None), (5, None, 1, "r1", None)], schema)
    new = spark.createDataFrame([(1, "b", 2, "r2", None), (2, "b", 4, "r2", "m"), (3, "b", 1, "r2", None), (4, "a", 9, "r2", None), (5, None, None, "r2", None), (6, "n", None, "r2", None)], schema).withColumn("extra", F.lit(1))
    merged = merge.authority_merge(old, new, spec)
    got = {r.k: (r.v, r.at, r.mdm_entity_id, r.outcome) for r in merged.collect()}
    assert got == {1: ("b", 2, "m1", "candidate"), 2: ("a", 5, None, "kept"), 3: ("a", 1, None, "conflict"), 4: ("a", 2, None, "same"), 5: (None, 1, None, "same"), 6: ("n", None, None, "new")}
    with pytest.raises(ValueError, match="1 keys"):
        merge.settled(merged)
    assert merge.settled(merge.authority_merge(old, old, spec)).count() == 5


def test_digest_is_free_of_order_and_counts_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    one = lambda df: tuple(merge.table_digest(df).first())
    assert one(a) == one(a.orderBy(F.desc("k"))) != one(a.distinct())
    assert one(a.where("false")) == (0, "0")


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    log = spark.createDataFrame(LOG, SCHEMA)
    log.repartition(5).write.parquet(str(tmp_path / "in"))
    spec = merge.MergeSpec(("id",), first=("name",), coalesce=("n",))
    run = lambda: ingest.merge_stream(ingest.file_stream(spark, str(tmp_path / "in"), log.schema, per_batch=1), str(tmp_path / "out"), str(tmp_path / "ck"), spec, "seq")
    run()
    want = sorted(map(str, merge.collapse(log, spec, "seq").collect()))
    assert sorted(map(str, ingest.merged(spark, str(tmp_path / "out"), spec, "seq").collect())) == want
    log.write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(map(str, ingest.merged(spark, str(tmp_path / "out"), spec, "seq").collect())) == want
    assert os.path.isdir(tmp_path / "ck")


@pytest.mark.parametrize("name", ["ups_merge", "ups_upsert", "ups_seed"])
def test_merges_take_whole_tables(spark, small, name):
    """Every customer, at a size where the keys go far beyond 1000, is matched, kept or inserted anew."""
    base = small.replace("sf0.001", "sf0.1")
    keys = [r[0] for r in spark.read.parquet(f"{base}/customer.parquet").select("c_custkey").collect()]
    got = Counter(r[0] for r in filings.QUERIES[name](spark, base).select("c_custkey").collect())
    assert max(keys) > 10_000 and got == Counter(keys) + Counter(-k for k in keys if k % 2)
