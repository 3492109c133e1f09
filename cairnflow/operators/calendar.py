"""Expected dates: sessions, business days, what is due, what has come, and how much of a universe is covered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of trading sessions (fixed values).
SESSIONS = {"bmo": "pre", "before market open": "pre", "pre": "pre", "amc": "post", "after market close": "post", "post": "post"}


def session_of(c: Column) -> Column:
    """pre, post or unknown."""
    known = F.create_map(*(F.lit(x) for kv in SESSIONS.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(c))), F.lit("unknown"))


def business_days(days: DataFrame, day: str, holidays: DataFrame, zone: str = "America/New_York", hour: int = 6) -> DataFrame:
    """Adds previous_day and next_day, the nearest days that are neither weekend nor holiday (within 10), and available_at: ``hour`` on the next one in ``zone``, as UTC."""
    closed = holidays.agg(F.collect_set("day").alias("__closed"))  # some eleven a year
    open_ones = lambda sign: F.filter(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.date_add(F.col(day), (sign * i).cast("int"))), lambda d: (F.weekday(d) < 5) & ~F.array_contains("__closed", d))
    out = days.crossJoin(F.broadcast(closed)).withColumns({"previous_day": open_ones(-1)[0], "next_day": open_ones(1)[0]}).drop("__closed")  # one row
    local = F.to_timestamp(F.concat(F.col("next_day").cast("string"), F.lit(f" {hour:02d}:00:00")))
    return out.withColumn("available_at", F.to_utc_timestamp(local, zone))


def mark_reported(calendar: DataFrame, releases: DataFrame, key: Sequence[str], accession: str, as_of: str) -> DataFrame:
    """Calendar rows whose release exists become reported as of ``as_of`` with its accession; reported and cancelled ones stay as they are.

    Several releases of one key: the greatest accession. The accession of rows that stay is NULL.
    """
    r = releases.groupBy(*key).agg(F.max(accession).alias(accession)).withColumn("__hit", F.lit(True))
    moves = F.col("__hit").isNotNull() & ~F.col("status").isin("reported", "cancelled")
    j = calendar.join(r, list(key), "left")
    return j.withColumns({accession: F.when(moves, F.col(accession)), "as_of": F.when(moves, F.lit(as_of).cast("date")).otherwise(F.col("as_of")), "status": F.when(moves, "reported").otherwise(F.col("status"))}).drop("__hit")


def next_days(calendar: DataFrame, today: str, days: int) -> DataFrame:
    """Rows still expected from ``today`` to ``days`` later, both included."""
    first = F.lit(today).cast("date")
    return calendar.where(F.col("status").isin("estimated", "confirmed") & F.col("expected_date").between(first, F.date_add(first, days)))


def coverage(calendar: DataFrame, universe: DataFrame, key: str, today: str, least: float = 0.80, few: int = 10) -> DataFrame:
    """(universe_size, covered, coverage_rate, meets): keys with a reported row or one expected from ``today`` on; no verdict below ``few`` keys."""
    ok = (F.col("status") == "reported") | (F.col("status").isin("estimated", "confirmed") & (F.col("expected_date") >= F.lit(today).cast("date")))
    hit = calendar.where(ok).select(key).distinct().withColumn("__ok", F.lit(True))
    n, c = F.count(F.lit(1)), F.count("__ok")
    rate = F.when(n > 0, c / n).otherwise(0.0)
    return universe.select(key).distinct().join(hit, key, "left").agg(n.alias("universe_size"), c.alias("covered"), rate.alias("coverage_rate"), F.when(n >= few, rate >= least).alias("meets"))
