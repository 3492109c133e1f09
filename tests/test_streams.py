"""Merged streams and publications survive a writer that fails between its steps."""

import os

import pytest
from pyspark.sql import functions as F

from cairnflow.operators.merge import MergeSpec
from cairnflow.sources import writers
from cairnflow.streaming import ingest

SPEC = MergeSpec(("k",), first=("a",))


def arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, "k int, n long, a string, b string").coalesce(1).write.parquet(os.path.join(folder, name))


def run(spark, folder, target):
    stream = spark.readStream.schema("k int, n long, a string, b string").parquet(os.path.join(folder, "*"))
    ingest.merge_stream(stream, target, os.path.join(target, "checkpoint"), SPEC, "n", 8)
    return {r.k: (r.n, r.a, r.b) for r in ingest.merged(spark, target, SPEC, "n").collect()}


def test_merge_touches_few_buckets_and_survives_a_crash(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, "1", [(i, 10 + i, f"a{i}", f"b{i}") for i in range(40)])
    first = run(spark, folder, target)
    assert len(first) == 40
    arrive(spark, folder, "2", [(3, 99, "late", "new"), (77, 1, "x", "y")])
    real = ingest.move_pointer

    def fail(*args):
        raise RuntimeError("the writer was lost")

    monkeypatch.setattr(ingest, "move_pointer", fail)
    with pytest.raises(Exception, match="writer was lost|STREAM_FAILED"):
        run(spark, folder, target)
    assert {r.k for r in ingest.merged(spark, target, SPEC, "n").collect()} == set(range(40))  # the table before the batch
    monkeypatch.setattr(ingest, "move_pointer", real)
    got = run(spark, folder, target)
    assert got == first | {3: (99, "a3", "new"), 77: (1, "x", "y")}
    assert len(os.listdir(os.path.join(target, "batch=1"))) < 8  # only the touched buckets were written again
    assert run(spark, folder, target) == got


def test_pointer_moves_forward_and_back(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        writers.published(spark, folder)
    writers.publish(spark.range(3), folder, "g1")
    writers.publish(spark.range(5), folder, "g2")
    assert writers.published(spark, folder).count() == 5
    writers.activate(spark, folder, "g1")
    assert writers.published(spark, folder).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        writers.activate(spark, folder, "g9")
    assert writers.published(spark, folder).count() == 3


def test_counts_decide_over_all_tables(spark, tmp_path):
    folder = str(tmp_path)
    writers.publish_checked({"a": spark.range(3), "b": spark.range(4)}, {"a": 3, "b": 4}, folder, "g1")
    with pytest.raises(ValueError, match="manifest says 9"):
        writers.publish_checked({"a": spark.range(7), "b": spark.range(8)}, {"a": 7, "b": 9}, folder, "g2")
    assert writers.published_table(spark, folder, "a").count() == 3


def test_retention_keeps_the_active_one(spark):
    rows = spark.createDataFrame([("g1", "2024-01-01"), ("g2", "2024-02-01"), ("g3", "2024-03-01")], "g string, at string").withColumn("at", F.to_date("at"))
    got = {r.g: r.keep for r in writers.retained(rows, "g", "at", 1, 10, "2024-06-01", "g1").collect()}
    assert got == {"g1": True, "g2": False, "g3": True}


def test_release_removes_the_cuts(spark):
    from cairnflow import session

    folder = session.shared_folder(spark).removeprefix("file://")
    held = lambda: {f for f in (os.listdir(folder) if os.path.isdir(folder) else ()) if f.startswith("cut-")}
    session.release(spark)
    before = held()
    df = session.cut(spark.range(3))
    assert df.count() == 3 and len(held() - before) == 1
    assert session.release(spark) == 1 and session.release(spark) == 0 and held() == before
