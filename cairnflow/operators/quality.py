"""Checks over tables: counts against the run before, drift by field hashes, digests, parity of readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions.text import row_hash
from cairnflow.operators.merge import table_digest


def shrunk_counts(previous: DataFrame, current: DataFrame, name: str = "table_name", count: str = "n_rows") -> DataFrame:
    """Tables whose count fell or that are gone: counts must not decrease."""
    both = previous.select(name, F.col(count).alias("before")).join(current.select(name, F.col(count).alias("after")), name, "full")
    return both.withColumn("state", F.when(F.col("after").isNull(), "gone").when(F.col("before").isNull(), "new").when(F.col("after") < F.col("before"), "shrunk").otherwise("ok"))


def field_drift(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], severe: Sequence[str] = ()) -> DataFrame:
    """(key, state, drifted, severity) over all keys of both sides: only_left, only_right, drift or same."""
    x = a.select(key, *(row_hash(F.col(f)).alias(f"x_{f}") for f in fields), F.lit(True).alias("__x"))
    y = b.select(key, *(row_hash(F.col(f)).alias(f"y_{f}") for f in fields), F.lit(True).alias("__y"))
    drifted = F.array_compact(F.array(*(F.when(F.col(f"x_{f}") != F.col(f"y_{f}"), F.lit(f)) for f in fields)))
    out = x.join(y, key, "full").withColumn("drifted", drifted)
    state = F.when(F.col("__y").isNull(), "only_left").when(F.col("__x").isNull(), "only_right").when(F.size("drifted") > 0, "drift").otherwise("same")
    severity = F.when(F.col("state") == "same", "none").when(F.col("state") != "drift", "high").when(F.arrays_overlap("drifted", F.array(*(F.lit(s) for s in severe)) if severe else F.lit(None).cast("array<string>")), "high").otherwise("low")
    return out.withColumn("state", state).withColumn("severity", severity).select(key, "state", F.array_join("drifted", ",").alias("drifted"), "severity")


def same_tables(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts and digests of both sides with the verdict."""
    x, y = (table_digest(t, columns).withColumnsRenamed({"n_rows": f"{p}_rows", "digest": f"{p}_digest"}) for t, p in ((a, "left"), (b, "right")))
    return x.crossJoin(y).withColumn("same", (F.col("left_rows") == F.col("right_rows")) & (F.col("left_digest") == F.col("right_digest")))  # one row each


def manifest_changes(manifest: DataFrame, name: str, at: str, digest: str, rows: str) -> DataFrame:
    """Adds previous digest and count of each table's run, whether it changed, and by how many rows."""
    w = Window.partitionBy(name).orderBy(at)
    return manifest.withColumns({"previous_digest": F.lag(digest).over(w), "row_delta": F.col(rows) - F.lag(rows).over(w)}).withColumn("changed", ~F.col(digest).eqNullSafe(F.col("previous_digest")))


def watermark_grade(df: DataFrame, at: str, now: str, most_days: int, ready: str) -> DataFrame:
    """Adds is_grade and reasons: fit for use only if ready, dated, not from the future and fresh enough; anything unknown fails."""
    age = F.datediff(F.lit(now).cast("date"), F.col(at).cast("date"))
    reasons = F.array_compact(F.array(F.when(~F.coalesce(F.col(ready), F.lit(False)), "not ready"), F.when(F.col(at).isNull(), "no watermark"), F.when(age < 0, "future watermark"), F.when(age > most_days, "stale")))
    return df.withColumn("reasons", F.array_join(reasons, ",")).withColumn("is_grade", F.col("reasons") == "")
