"""Differences between two copies of a dataset, field by field.

Both sides are reduced to one row per key, cut into hash buckets and cogrouped as Arrow
tables. Inside a bucket keys are aligned by sorted search and columns compared through
null-aware masks; only the masked cells leave the executor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = "object_key string, difference string, field_name string, left_value string, right_value string"


def one_per_key(df: DataFrame, key: str, fields: Sequence[str], order: Column | None = None) -> DataFrame:
    """The row of each key that is greatest by ``order``, then by content; repeats collapse before the shuffle."""
    order = F.lit(0) if order is None else order
    kept = df.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.struct(order.alias("o"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields))).alias("__row"))
    kept = kept.groupBy("__key").agg(F.max("__row").alias("__row"))
    return kept.select(F.col("__key").cast("string").alias("__key"), *(F.col(f"__row.f{i}").alias(f"f{i}") for i in range(len(fields))))


def compare_bucket(left: pa.Table, right: pa.Table, fields: Sequence[str]) -> pa.Table:
    """The differing cells of two Arrow tables with unique ``__key``; columns f0, f1, ... are the fields."""

    def ordered(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        keys = np.asarray(t.column("__key").to_pylist(), dtype=object)
        at = np.argsort(keys, kind="stable") if len(keys) else np.zeros(0, dtype=np.int64)
        return t.take(pa.array(at, type=pa.int64())), keys[at]

    left, a = ordered(left)
    right, b = ordered(right)
    at = np.searchsorted(b, a) if len(b) and len(a) else np.zeros(len(a), dtype=np.int64)
    inside = at < len(b)
    hit = np.zeros(len(a), dtype=bool)
    hit[inside] = b[at[inside]] == a[inside]
    lost = np.ones(len(b), dtype=bool)
    lost[at[hit]] = False
    out: list[list] = [[], [], [], [], []]

    def put(keys: Sequence, difference: str, field: str, lv: Sequence, rv: Sequence) -> None:
        for column, values in zip(out, (keys, [difference] * len(keys), [field] * len(keys), lv, rv)):
            column.extend(values)

    gone = a[~hit].tolist()
    put(gone, "missing_right", "", [None] * len(gone), [None] * len(gone))
    extra = b[lost].tolist()
    put(extra, "missing_left", "", [None] * len(extra), [None] * len(extra))
    lt, rt = left.filter(pa.array(hit)), right.take(pa.array(at[hit], type=pa.int64()))
    both = a[hit]
    for i, field in enumerate(fields):
        x, y = lt.column(f"f{i}").combine_chunks(), rt.column(f"f{i}").combine_chunks()
        mask = pc.or_(pc.xor(pc.is_null(x), pc.is_null(y)), pc.fill_null(pc.not_equal(x, y), False))
        picked = np.asarray(mask.to_pylist(), dtype=bool) if len(both) else np.zeros(0, dtype=bool)
        if picked.any():
            put(both[picked].tolist(), "value", field, x.filter(mask).to_pylist(), y.filter(mask).to_pylist())
    return pa.table([pa.array(c, type=pa.string()) for c in out], names=["object_key", "difference", "field_name", "left_value", "right_value"])


def table_diff(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str], left_order: Column | None = None, right_order: Column | None = None, bucket_rows: int = 20_000) -> DataFrame:
    """(object_key, difference, field_name, left_value, right_value), one row per missing object or differing cell.

    difference is missing_left, missing_right (field_name '') or value. Fields are
    compared as strings, NULL equals NULL and nothing else. A key with several rows
    stands for the one that is greatest by its side's order (then by content), so
    repeated rows change nothing. Rows without a key name no object and are left out.
    Two empty sides give no row; other columns of the inputs are ignored. Buckets hold
    about ``bucket_rows`` keys whatever the size of the tables.
    """
    fields = list(fields)
    spark = left.sparkSession
    a, b = one_per_key(left, key, fields, left_order), one_per_key(right, key, fields, right_order)
    rows = max(left.select(key).count(), right.select(key).count())
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / bucket_rows))
    bucket = F.pmod(F.xxhash64("__key"), F.lit(buckets)).cast("int")

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        return compare_bucket(x, y, fields)

    return a.withColumn("__bucket", bucket).groupBy("__bucket").cogroup(b.withColumn("__bucket", bucket).groupBy("__bucket")).applyInArrow(compare, CELLS)


def parity(left: DataFrame, right: DataFrame, key: str, kind: str) -> DataFrame:
    """Per kind: left_count, right_count, left_minus_right, right_minus_left of distinct keys, and status pass or fail.

    Both sides have ``key`` and ``kind``; a key counts under each of its kinds. NULL keys
    don't count; a NULL kind is its own kind.
    """
    sides = left.select(key, kind, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, kind, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = sides.where(F.col(key).isNotNull()).groupBy(kind, key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    out = seen.groupBy(kind).agg(
        F.sum("l").cast("long").alias("left_count"),
        F.sum("r").cast("long").alias("right_count"),
        F.sum(F.col("l") * (1 - F.col("r"))).cast("long").alias("left_minus_right"),
        F.sum(F.col("r") * (1 - F.col("l"))).cast("long").alias("right_minus_left"),
    )
    return out.withColumn("status", F.when((F.col("left_minus_right") == 0) & (F.col("right_minus_left") == 0) & (F.col("left_count") == F.col("right_count")), "pass").otherwise("fail"))
