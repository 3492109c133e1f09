"""Relational building blocks that plain DataFrame calls leave open: top rows, as-of and interval joins, fallbacks, digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; the rank is pushed below the shuffle."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= n).drop("__r")


def shifted(df: DataFrame, key: Sequence[str], step: str, lag: int, values: Sequence[str], suffix: str) -> DataFrame:
    """Left self join on ``step`` - ``lag``: a gap gives NULL, unlike a window's lag."""
    past = df.select(*key, (F.col(step) + lag).alias(step), *(F.col(v).alias(f"{v}{suffix}") for v in values))
    return df.join(past, [*key, step], "left")


def as_of(left: DataFrame, right: DataFrame, key: Sequence[str], left_at: str, right_at: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the latest right values at or before its moment.

    Both sides are sorted once per key and the last known values carried forward; no pairs are made. Several right
    rows at one moment: the greatest by content. NULL keys match nothing.
    """
    r = right.groupBy(*key, right_at).agg(F.max(F.struct(*values)).alias("__v")).select(*key, F.col(right_at).alias("__at"), F.lit(0).alias("__side"), "__v")
    l = left.withColumn("__row", F.struct(*left.columns)).select(*key, F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(dict(r.dtypes)["__v"]).alias("__v"), "__row")
    w = Window.partitionBy(*key).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = l.unionByName(r, allowMissingColumns=True).withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where(F.col("__side") == 1)
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return carried.select("__row.*", *(F.when(known, F.col(f"__v.{v}")).alias(v) for v in values))


def overlapping(a: DataFrame, b: DataFrame, key: Sequence[str], a_from: str, a_to: str, b_from: str, b_to: str) -> DataFrame:
    """Pairs of one key whose half-open intervals overlap; NULL ends are open. Equality first, the range as a residual."""
    joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key])
    return joined.where((F.col(f"b.{b_to}").isNull() | F.col(f"a.{a_from}").isNull() | (F.col(f"a.{a_from}") < F.col(f"b.{b_to}"))) & (F.col(f"a.{a_to}").isNull() | F.col(f"b.{b_from}").isNull() | (F.col(f"b.{b_from}") < F.col(f"a.{a_to}"))))


def valid_at(df: DataFrame, at: Column, start: str, end: str) -> DataFrame:
    """Rows whose half-open interval holds ``at``."""
    return df.where((F.col(start).isNull() | (F.col(start) <= at)) & (F.col(end).isNull() | (F.col(end) > at)))


def member_of_any(df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str) -> DataFrame:
    """Rows of which any of ``columns`` is among ``keys``: a union of semi joins instead of ORed lookups. ``df`` must hold no repeated rows."""
    out = None
    for c in columns:
        one = df.join(keys.select(F.col(key).alias(c)).distinct(), c, "left_semi").select(*df.columns)
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def with_fallback(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """``df``, or ``fallback`` where ``df`` has no row."""
    some = df.limit(1).select(F.lit(1).alias("__some"))
    return df.unionByName(fallback.join(F.broadcast(some), F.lit(True), "left_anti"))  # at most one row


def coverage(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, n_rows, n_known, known_ratio) in one pass, unpivoted afterwards."""
    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"__{c}") for c in columns))
    long = one.unpivot([*by, "n_rows"], [f"__{c}" for c in columns], "column_name", "n_known")
    return long.withColumn("column_name", F.substring("column_name", 3, 1000)).withColumn("known_ratio", F.when(F.col("n_rows") > 0, F.col("n_known") / F.col("n_rows")))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """(n_rows, n_orphans): rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_key).alias("__p")).distinct()
    marked = child.join(keys, child[child_key] == keys["__p"], "left")
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(child_key).isNotNull() & F.col("__p").isNull()).alias("n_orphans"))


def date_spine(spark, first: str, last: str) -> DataFrame:
    """Every day between two ISO dates with its parts; Monday is 0."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.select("day", (F.year("day") * 10000 + F.month("day") * 100 + F.dayofmonth("day")).alias("date_key"), F.year("day").alias("year"), F.quarter("day").alias("quarter"), F.month("day").alias("month"), F.dayofmonth("day").alias("day_of_month"), F.weekday("day").alias("day_of_week"), (F.weekday("day") >= 5).alias("is_weekend"))


def federal_holidays(spark, first_year: int, last_year: int) -> DataFrame:
    """(day, name) of US federal holidays as observed: on a Saturday the day before, on a Sunday the day after."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    fixed = lambda m, d: F.make_date("y", F.lit(m), F.lit(d))

    def nth(month: int, weekday: int, n: int) -> Column:
        start = fixed(month, 1)
        return F.date_add(start, F.pmod(F.lit(weekday) - F.weekday(start), F.lit(7)).cast("int") + 7 * (n - 1))

    last_monday = F.date_sub(F.last_day(fixed(5, 1)), F.weekday(F.last_day(fixed(5, 1))).cast("int"))
    rows = [("new year", fixed(1, 1)), ("king", nth(1, 0, 3)), ("washington", nth(2, 0, 3)), ("memorial", last_monday), ("independence", fixed(7, 4)), ("labor", nth(9, 0, 1)), ("columbus", nth(10, 0, 2)), ("veterans", fixed(11, 11)), ("thanksgiving", nth(11, 3, 4)), ("christmas", fixed(12, 25))]
    rows.append(("juneteenth", F.when(F.col("y") >= 2021, fixed(6, 19))))
    stacked = years.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), d.alias("d")) for n, d in rows))).alias("h")).select("h.name", "h.d").where("d IS NOT NULL")
    return stacked.select(F.when(F.weekday("d") == 5, F.date_sub("d", 1)).when(F.weekday("d") == 6, F.date_add("d", 1)).otherwise(F.col("d")).alias("day"), "name")


def next_business_day(days: DataFrame, day: str, holidays: DataFrame) -> DataFrame:
    """Adds ``next_day``: the first later day that is neither weekend nor holiday (at most 10 days on)."""
    closed = holidays.agg(F.collect_set("day").alias("__closed"))  # some eleven a year
    later = F.filter(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.date_add(F.col(day), i.cast("int"))), lambda d: (F.weekday(d) < 5) & ~F.array_contains("__closed", d))
    return days.crossJoin(F.broadcast(closed)).withColumn("next_day", later[0]).drop("__closed")  # one row


def not_among(df: DataFrame, column: str, keys: DataFrame, key: str, unknown: str = "sql") -> DataFrame:
    """Rows whose value is not among ``keys``, with a stated rule for NULLs.

    ``sql``: as NOT IN does it, a NULL among the keys leaves no row, and a NULL value passes only where there are no keys at all.
    ``keep``: NULL keys don't count, NULL values pass. ``drop``: NULL keys don't count, NULL values don't pass.
    """
    known = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("__k")).distinct()
    rest = df.join(known, F.col(column) == F.col("__k"), "left_anti")
    if unknown == "keep":
        return rest
    if unknown == "drop":
        return rest.where(F.col(column).isNotNull())
    told = keys.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(key).isNull()).alias("__nulls"))
    passes = (F.col("__nulls") == 0) & (F.col(column).isNotNull() | (F.col("__n") == 0))
    return rest.crossJoin(F.broadcast(told)).where(passes).drop("__n", "__nulls")  # one row
