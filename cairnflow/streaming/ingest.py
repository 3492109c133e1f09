"""Streams over folders: every file once, merges that repeats and disorder can't change, event-time windows."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.operators.merge import MergeSpec, collapse, essential
from cairnflow.sources.writers import move_pointer, read_pointer


def file_stream(spark: SparkSession, folder: str, schema, kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """A stream of the files in ``folder``; each is read once, as the checkpoint remembers."""
    reader = spark.readStream.schema(schema).format(kind)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Handles what has arrived, batch by batch, and ends."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start().awaitTermination()


#: Buckets of keys into which a merged table is cut; a batch rewrites those it touches.
BUCKETS = 64


def merge_stream(stream: DataFrame, target: str, checkpoint: str, spec: MergeSpec, seq: str, buckets: int = BUCKETS) -> None:
    """Keeps in ``target`` the rows that the collapse by ``spec`` rests on, cut into buckets of keys.

    A batch writes the buckets it touches beside the ones they replace, then a pointer moves that says which batch wrote each bucket; nothing is
    deleted, so a reader or a restarted writer finds the table before or after the batch, never none. A batch that the pointer knows is
    skipped, and collapsing is idempotent, so replays and late or repeated rows change nothing that their sequence doesn't entitle them to.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done, held = _state(spark, target)
        if number <= done:
            return
        key = F.pmod(F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in spec.key)), F.lit(buckets)).cast("int")
        new = batch.withColumn("bucket", key)
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most ``buckets``
        old = [_bucket(target, held[b], b) for b in touched if b in held]
        rows = new.drop("bucket")
        if old:
            rows = spark.read.schema(rows.schema).parquet(*old).unionByName(rows)
        essential(rows, spec, seq).withColumn("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(target, f"batch={number}"))
        move_pointer(spark, target, str(number), json.dumps(held | dict.fromkeys(touched, number)))

    run_available(stream, checkpoint, handle)


def _bucket(target: str, batch: int, bucket: int) -> str:
    return os.path.join(target, f"batch={batch}", f"bucket={bucket}")


def _state(spark: SparkSession, target: str) -> tuple[int, dict[int, int]]:
    """(the last batch that was merged or -1, which batch wrote each bucket)."""
    found = read_pointer(spark, target)
    return (int(found[1]), {int(b): n for b, n in json.loads(found[2]).items()}) if found else (-1, {})


def merged(spark: SparkSession, target: str, spec: MergeSpec, seq: str) -> DataFrame:
    """The collapsed table as of the last batch; raises if no batch was merged yet."""
    _, held = _state(spark, target)
    if not held:
        raise FileNotFoundError(f"no batch was merged into {target}")
    return collapse(spark.read.parquet(*(_bucket(target, n, b) for b, n in sorted(held.items()))), spec, seq)


def windowed_counts(stream: DataFrame, at: str, key: str, size: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts per event-time window and key with a watermark; tumbling, or sliding with ``slide``."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def first_seen(stream: DataFrame, key: str, at: str, late: str = "2 days") -> DataFrame:
    """The stream without rows whose key was seen within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
