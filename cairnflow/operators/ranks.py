"""Positions within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], size: Column | None = None, salts: int = 64, name: str = "rank") -> DataFrame:
    """Adds ``name``: the sum of ``size`` over the rows before this one in its group (0-based rank where size is None).

    The order within a group is by a hash bucket of the ``order`` columns, then by them:
    fixed by content, unlike arrival. Each (group, bucket) is ranked apart and the buckets'
    totals are summed, so a group that holds a third of all rows is spread over ``salts``
    tasks. Equal rows get neighbouring ranks. NULLs in ``by`` form one group.
    """
    size = F.lit(1).cast("long") if size is None else size
    salted = df.withColumn("__size", size).withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    inner = Window.partitionBy(*by, "__salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = salted.withColumn("__upto", F.sum("__size").over(inner))
    totals = salted.groupBy(*by, "__salt").agg(F.sum("__size").alias("__total"))
    outer = Window.partitionBy(*by).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("__base", F.coalesce(F.sum("__total").over(outer), F.lit(0)))
    keys = [*by, "__salt"]
    same = [ranked[c].eqNullSafe(bases[c]) for c in keys]
    condition = same[0]
    for x in same[1:]:
        condition = condition & x
    joined = ranked.join(bases, condition, "left")
    return joined.select(*(ranked[c] for c in df.columns), (F.col("__base") + F.col("__upto") - F.col("__size")).cast("long").alias(name))
