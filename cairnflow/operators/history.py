"""Histories of changing attributes: validity periods from snapshots or updates.

Each entity's observations become one sorted array of structs; a higher-order fold carries
values over NULLs and appends a version only upon change. Entities with more
observations than one array should hold are cut into segments: the fold runs per
segment, and what earlier segments leave behind is handed on to the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Observations that one array holds at most.
SEGMENT_ROWS = 2_000


def blank_insensitive(c: Column) -> Column:
    """Lower case, trimmed, blanks collapsed."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def _observed(df: DataFrame, entity: str, at: str, seq: str | None, attributes: Sequence[str]) -> DataFrame:
    """One row per entity and moment: the one with the greatest ``seq``, then content."""
    rank = F.coalesce(F.col(seq).cast("long"), F.lit(-(2**63) + 1)) if seq else F.lit(0)
    row = F.struct(rank.alias("s"), *(F.col(a).alias(f"a{i}") for i, a in enumerate(attributes)))
    kept = df.where(F.col(entity).isNotNull() & F.col(at).isNotNull())
    return kept.groupBy(F.col(entity).alias("__e"), F.col(at).alias("__at")).agg(F.max(row).alias("__r")).select("__e", "__at", *(F.col(f"__r.a{i}").alias(f"a{i}") for i in range(len(attributes))))


def _segments(seen: DataFrame, segment_rows: int) -> DataFrame:
    """(__e, __minute, __seg) of the entities with more than ``segment_rows`` observations.

    The boundaries follow exact counts per minute, so every run finds the same ones.
    """
    big = seen.groupBy("__e").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > segment_rows).select("__e")
    minutes = seen.select("__e", F.date_trunc("minute", "__at").alias("__minute")).join(big, "__e", "left_semi").groupBy("__e", "__minute").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__e").orderBy("__minute").rowsBetween(Window.unboundedPreceding, -1)
    return minutes.withColumn("__seg", F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / segment_rows).cast("int")).select("__e", "__minute", "__seg")


def versions(df: DataFrame, entity: str, at: str, attributes: Sequence[str], seq: str | None = None, compare: Mapping[str, Column] | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(entity, valid_from, valid_to, is_current, attributes...): one row per version.

    Rows are taken by ``at``; of several at one moment only that with the greatest ``seq``
    counts (NULL is least, ties by content). A NULL attribute was not supplied and the
    earlier value holds on. A version starts with the first row and wherever an attribute
    differs from the version before; ``compare`` maps an attribute to a function of its
    column under which values are compared (what is kept is the value at the start of the
    version). A return to earlier values is a new version. valid_to is the next version's
    start, NULL for the last. Rows without an entity or a moment belong to no version;
    repeated rows change nothing; an empty table gives no row.
    """
    attributes, compare = list(attributes), dict(compare or {})
    ids = range(len(attributes))
    kinds = [dict(df.dtypes)[a] for a in attributes]
    at_kind = dict(df.dtypes)[at]
    seen = _observed(df, entity, at, seq, attributes)
    seen = seen.select("__e", "__at", *(f"a{i}" for i in ids), *((compare[a](F.col(f"a{i}")) if a in compare else F.col(f"a{i}")).alias(f"c{i}") for i, a in enumerate(attributes)))
    marks = _segments(seen, segment_rows)
    seen = seen.withColumn("__minute", F.date_trunc("minute", "__at")).join(marks, ["__e", "__minute"], "left").withColumn("__seg", F.coalesce("__seg", F.lit(0)))
    row = F.struct("__at", *(f"a{i}" for i in ids), *(f"c{i}" for i in ids))
    arrays = seen.groupBy("__e", "__seg").agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    compared = [dict(seen.dtypes)[f"c{i}"] for i in ids]
    state = "struct<n: int, " + ", ".join(f"a{i}: {k}, c{i}: {c}" for i, (k, c) in enumerate(zip(kinds, compared))) + ">"
    version = f"struct<at: {at_kind}, " + ", ".join(f"a{i}: {k}" for i, k in enumerate(kinds)) + ">"
    nothing = F.expr(f"named_struct('n', 0, {', '.join(f'{chr(39)}a{i}{chr(39)}, cast(null as {k}), {chr(39)}c{i}{chr(39)}, cast(null as {c})' for i, (k, c) in enumerate(zip(kinds, compared)))})").cast(state)

    def carried(s: Column, x: Column) -> Column:
        return F.struct((s["n"] + 1).alias("n"), *(p for i in ids for p in (F.coalesce(x[f"a{i}"], s[f"a{i}"]).alias(f"a{i}"), F.coalesce(x[f"c{i}"], s[f"c{i}"]).alias(f"c{i}")))).cast(state)

    # What each segment leaves behind by itself, and so what is known before it begins; most entities have one segment and need none of it.
    several = arrays.join(marks.select("__e").distinct(), "__e", "left_semi")
    left = several.select("__e", "__seg", F.aggregate("__rows", nothing, carried).alias("__left"))
    before = Window.partitionBy("__e").orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    known = left.select("__e", "__seg", F.struct(F.coalesce(F.sum(F.col("__left.n")).over(before).cast("int"), F.lit(0)).alias("n"), *(p for i in ids for p in (F.last(F.col(f"__left.a{i}"), True).over(before).alias(f"a{i}"), F.last(F.col(f"__left.c{i}"), True).over(before).alias(f"c{i}")))).cast(state).alias("__known"))
    arrays = arrays.join(known, ["__e", "__seg"], "left").withColumn("__known", F.coalesce("__known", nothing))

    def step(acc: Column, x: Column) -> Column:
        now = carried(acc["now"], x)
        changed = acc["now"]["n"] == 0
        for i in ids:
            changed = changed | ~now[f"c{i}"].eqNullSafe(acc["now"][f"c{i}"])
        new = F.array(F.struct(x["__at"].alias("at"), *(now[f"a{i}"].alias(f"a{i}") for i in ids)).cast(version))
        return F.struct(now.alias("now"), F.when(changed, F.concat(acc["found"], new)).otherwise(acc["found"]).alias("found")).cast(f"struct<now: {state}, found: array<{version}>>")

    start = F.struct(F.col("__known").alias("now"), F.expr(f"cast(array() as array<{version}>)").alias("found")).cast(f"struct<now: {state}, found: array<{version}>>")
    found = arrays.select("__e", F.explode(F.aggregate("__rows", start, step)["found"]).alias("v"))
    flat = found.select(F.col("__e").alias(entity), F.col("v.at").alias("valid_from"), *(F.col(f"v.a{i}").alias(a) for i, a in enumerate(attributes)))
    after = F.lead("valid_from").over(Window.partitionBy(entity).orderBy("valid_from"))
    return flat.withColumn("valid_to", after).withColumn("is_current", F.col("valid_to").isNull()).select(entity, "valid_from", "valid_to", "is_current", *attributes)


def with_former_names(history: DataFrame, former: DataFrame, entity: str, name: str, former_name: str = "former_name", changed: str = "date_changed", ordinal: str = "ordinal") -> DataFrame:
    """(entity, record_kind, name, valid_from, valid_to, ordinal): names before and within the observed history.

    ``history`` comes from versions(); its versions are merged to periods of one name
    (kind 'observed'). A former name held until its date of change, from the change of the
    next older one (greater ordinal) where that is dated (kind 'former'); a missing date
    leaves that end open (NULL). Repeats of (entity, ordinal) collapse to the greatest row;
    former names of entities never observed stay. Names are compared without case and blanks.
    """
    key = blank_insensitive(F.col(name))
    order = Window.partitionBy(entity).orderBy("valid_from")
    marked = history.withColumn("__new", ~F.lag(key).over(order).eqNullSafe(key) | (F.row_number().over(order) == 1)).where("__new")
    seen = marked.select(entity, F.lit("observed").alias("record_kind"), F.col(name).alias("name"), F.col("valid_from"), F.lead("valid_from").over(order).alias("valid_to"), F.lit(None).cast("int").alias("ordinal"))
    one = former.where(F.col(entity).isNotNull() & F.col(former_name).isNotNull()).groupBy(entity, ordinal).agg(F.max(F.struct(F.col(changed).alias("d"), F.col(former_name).alias("n"))).alias("r"))
    older = Window.partitionBy(entity).orderBy(F.col(ordinal).desc_nulls_first())
    past = one.select(entity, F.lit("former").alias("record_kind"), F.col("r.n").alias("name"), F.lag(F.col("r.d")).over(older).cast("timestamp").alias("valid_from"), F.col("r.d").cast("timestamp").alias("valid_to"), F.col(ordinal).cast("int").alias("ordinal"))
    return seen.unionByName(past)
