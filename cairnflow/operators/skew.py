"""Per-key work when a few keys hold most rows.

Heavy keys are found by a frequent-items sketch that is merged on the map side, then
counted exactly. Their rows are aggregated in two salted steps and joined by broadcast;
all other keys take one ordinary shuffle; both parts are united.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items kept by the sketch; its error is at most 3.5 / TRACKED of all rows.
TRACKED = 4096
SALTS = 32


def heavy_keys(df: DataFrame, key: str, share: float = 0.02, tracked: int = TRACKED) -> DataFrame:
    """(key, n_rows, total_rows, share): the non-NULL keys with at least ``share`` of all rows of ``df``.

    Exact: the sketch can't miss a key above ``share`` - 3.5/tracked, and every candidate
    is counted. NULL is no key, yet its rows count in the total. An empty table gives no
    row. Ties all stay. At most 1/(share - error) candidates are ever broadcast.
    """
    error = 3.5 / tracked
    if not error < share <= 1:
        raise ValueError(f"share must lie between the sketch's error {error:.5f} and 1")
    most = math.ceil(1 / (share - error)) + 1
    rows = df.select(F.col(key).alias("__key"))
    sketch = rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.expr(f"approx_top_k(__key, {most}, {tracked}) FILTER (WHERE __key IS NOT NULL)").alias("__top"),
    ).select("total_rows", F.explode(F.col("__top.item")).alias("__key"))
    counted = rows.join(F.broadcast(sketch.select("__key")), "__key").groupBy("__key").agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        counted.join(F.broadcast(sketch), "__key")
        .where(F.col("n_rows") >= F.lit(share) * F.col("total_rows"))
        .select(F.col("__key").alias(key), "n_rows", "total_rows", (F.col("n_rows") / F.col("total_rows")).alias("share"))
    )


def split_heavy(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of heavy keys, all other rows); rows with a NULL key are among the others."""
    marks = F.broadcast(heavy.select(key))  # at most 1/share rows
    return df.join(marks, key, "left_semi"), df.join(marks, key, "left_anti")


def _salt(n: int) -> Column:
    """Spreads rows evenly; the results don't depend on it."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")


def skew_aggregate(df: DataFrame, key: str, counts: Sequence[str] = (), sums: dict[str, Column] | None = None, firsts: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, heavy: DataFrame | None = None, share: float = 0.02, salts: int = SALTS) -> DataFrame:
    """Exact results per key: n_rows, non-NULL counts (n_<column>), sums, least and greatest values.

    ``sums``, ``firsts`` and ``lasts`` map result names to expressions; a struct in
    ``lasts`` carries the latest row along with its order. NULL keys form one group, as in
    SQL. A heavy key is reduced per salt first, so no task sees more than its share.
    """
    heavy = heavy_keys(df, key, share) if heavy is None else heavy
    sums, firsts, lasts = sums or {}, firsts or {}, lasts or {}
    part = [F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in counts)]
    part += [F.sum(e).alias(n) for n, e in sums.items()] + [F.min(e).alias(n) for n, e in firsts.items()] + [F.max(e).alias(n) for n, e in lasts.items()]
    whole = [F.sum(n).alias(n) for n in ("n_rows", *(f"n_{c}" for c in counts), *sums)]
    whole += [F.min(n).alias(n) for n in firsts] + [F.max(n).alias(n) for n in lasts]
    hot, cold = split_heavy(df, key, heavy)
    hot = hot.withColumn("__salt", _salt(salts)).groupBy(key, "__salt").agg(*part).groupBy(key).agg(*whole)
    out = hot.unionByName(cold.groupBy(key).agg(*part))
    return out.select(key, *(F.col(c).cast("long").alias(c) for c in ("n_rows", *(f"n_{c}" for c in counts))), *sums, *firsts, *lasts)


def skew_latest(df: DataFrame, key: str, order: Sequence[Column], n: int = 1, heavy: DataFrame | None = None, share: float = 0.02, salts: int = SALTS) -> DataFrame:
    """The ``n`` rows of each key that come first under ``order`` (which must be total for a defined result).

    Heavy keys keep the best ``n`` per salt before the final ranking.
    """
    heavy = heavy_keys(df, key, share) if heavy is None else heavy
    hot, cold = split_heavy(df, key, heavy)

    def best(rows: DataFrame, *by: str) -> DataFrame:
        return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rank") <= n).drop("__rank")

    hot = best(best(hot.withColumn("__salt", _salt(salts)), key, "__salt").drop("__salt"), key)
    return hot.unionByName(best(cold, key))


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", heavy: DataFrame | None = None, share: float = 0.02, most: int = 100_000, salts: int = SALTS) -> DataFrame:
    """Join on ``key`` with ``left`` skewed; ``how`` is inner or left.

    Rows of heavy keys meet the right side's few rows by broadcast if those are at most
    ``most`` (they are counted first), else by a salted join; all others are joined by an
    ordinary shuffle. NULL keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    heavy = heavy_keys(left, key, share) if heavy is None else heavy
    hot, cold = split_heavy(left, key, heavy)
    hot_right = right.join(F.broadcast(heavy.select(key)), key, "left_semi")
    if hot_right.limit(most + 1).count() <= most:
        joined = hot.join(F.broadcast(hot_right), key, how)
    else:
        spread = hot_right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = hot.withColumn("__salt", _salt(salts)).join(spread, [key, "__salt"], how).drop("__salt")
    return joined.unionByName(cold.join(right, key, how))
