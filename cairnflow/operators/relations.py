"""Relationships between golden records: derivation, roles, closing, settling of versions, coverage, and the graph built of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions.keys import hash_key

#: Open ends of an interval.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


def role(director: Column, officer: Column, ten_percent: Column) -> Column:
    """The one role of an owner who may have several: director before officer before holder of ten per cent before other."""
    return F.when(director, "director").when(officer, "officer").when(ten_percent, "10pct_owner").otherwise("other")


def relationship_id(kind: Column, source: Column, target: Column) -> Column:
    return F.sha2(F.concat_ws("|", kind, source.cast("string"), target.cast("string")), 256)


def edges(rows: DataFrame, kind: str, source: Column, target: Column, system: str, valid_from: Column | None = None, accession: Column | None = None, properties: Mapping[str, Column] | None = None) -> DataFrame:
    """Edges of one kind: (rel_type_name, relationship_id, source_id, target_id, valid_from, valid_to, source_system, source_accession, properties).

    Identical evidence (ends and properties) is one edge from its earliest date and least accession; rows with an unknown end make none.
    """
    day = F.lit(None).cast("date") if valid_from is None else valid_from
    told = F.lit("{}") if not properties else F.to_json(F.struct(*(c.alias(n) for n, c in properties.items())), {"ignoreNullFields": "false"})
    made = rows.select(source.cast("string").alias("source_id"), target.cast("string").alias("target_id"), day.alias("d"), (F.lit(None).cast("string") if accession is None else accession).alias("a"), told.alias("properties"))
    known = made.where(F.col("source_id").isNotNull() & F.col("target_id").isNotNull()).groupBy("source_id", "target_id", "properties").agg(F.min("d").alias("valid_from"), F.min("a").alias("source_accession"))
    return known.select(F.lit(kind).alias("rel_type_name"), relationship_id(F.lit(kind), F.col("source_id"), F.col("target_id")).alias("relationship_id"), "source_id", "target_id", "valid_from", F.lit(None).cast("date").alias("valid_to"), F.lit(system).alias("source_system"), "source_accession", "properties")


def first_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the least value of every known key, so that a lookup never multiplies rows."""
    return df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def resolution(rows: DataFrame, excluded: Column, source: Column, target: Column) -> DataFrame:
    """Adds ``outcome``: corporate (excluded), unresolved_source, unresolved_target or resolved, judged in this order."""
    return rows.withColumn("outcome", F.when(F.coalesce(excluded, F.lit(False)), "corporate").when(source.isNull(), "unresolved_source").when(target.isNull(), "unresolved_target").otherwise("resolved"))


def changed_spans(rows: DataFrame, key: str, order: str, name: str, start: str) -> DataFrame:
    """(key, name, valid_from, valid_to): runs of one name along ``order``; a change closes the span before it on the day it starts.

    Names are compared trimmed and in lower case; a NULL name neither changes nor opens anything.
    """
    w = Window.partitionBy(key).orderBy(order, start, name)
    clean = F.lower(F.trim(F.col(name)))
    known = rows.where(F.col(name).isNotNull()).withColumn("__new", ~F.lag(clean).over(w).eqNullSafe(clean))
    begun = known.where("__new").select(key, name, F.col(start).alias("valid_from"), order)
    return begun.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(key).orderBy(order, "valid_from", name))).drop(order)


def close_versions(versions: DataFrame, closures: DataFrame, key: str, start: str, end: str, at: str) -> DataFrame:
    """Open versions of a key named in ``closures`` end at its date; versions that end already or begin later stay."""
    c = closures.groupBy(key).agg(F.min(at).alias("__at"))
    hit = F.col(end).isNull() & F.col("__at").isNotNull() & (F.col(start).isNull() | (F.col(start) < F.col("__at")))
    return versions.join(c, key, "left").withColumn(end, F.when(hit, F.col("__at")).otherwise(F.col(end))).drop("__at")


def settle_versions(rows: DataFrame, key: str, start: str, end: str, priority: str, order: Sequence[str], evidence: Sequence[str]) -> DataFrame:
    """Adds ``state`` to versioned edges of one key: current, superseded, quarantined or duplicate.

    Equal evidence: the first by ``order`` stays, others are duplicates. Overlapping and different: the least
    ``priority`` number wins and the others are superseded; without a sole winner all that tie are quarantined. Disjoint ones are
    all current. A version meets the sorted versions of each lesser or equal priority, of which there are few: the greatest end before it and the
    least start after it tell whether any overlaps, so no pairs are made. Results don't depend on arrival.
    """
    first = F.row_number().over(Window.partitionBy(key, *evidence, start, end).orderBy(*order))
    content = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in (key, *order, *evidence, start, end)))
    marked = rows.withColumn("__first", first).withColumn("__id", F.sha2(content, 256))
    unique = marked.where("__first = 1").select(F.col(key).alias("k"), "__id", F.coalesce(start, F.lit(FIRST_DAY).cast("date")).alias("s"), F.coalesce(end, F.lit(LAST_DAY).cast("date")).alias("e"), F.col(priority).alias("p"))
    levels = unique.groupBy("k").agg(F.collect_set("p").alias("levels"))  # priorities of one key
    met = unique.join(levels, "k").withColumn("level", F.explode(F.filter("levels", lambda x: x <= F.col("p")))).withColumn("own", F.col("level") == F.col("p"))
    w = Window.partitionBy("k", "level").orderBy("s", "__id")
    before = F.max(F.when(F.col("own"), F.col("e"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("own"), F.col("s"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    clash = F.coalesce(before > F.col("s"), F.lit(False)) | F.coalesce(after < F.col("e"), F.lit(False))
    judged = met.withColumn("clash", clash).groupBy("__id").agg(F.max(F.col("clash") & ~F.col("own")).alias("beaten"), F.max(F.col("clash") & F.col("own")).alias("tied"))
    state = F.when(F.col("__first") > 1, "duplicate").when(F.col("beaten"), "superseded").when(F.col("tied"), "quarantined").otherwise("current")
    return marked.join(judged, "__id", "left").withColumn("state", state).select(*rows.columns, "state")


def coverage_manifest(instances: DataFrame, kind: str, kinds: Sequence[str], excluded: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """(kind, n_rows, state, reason, fingerprint): every kind with its count and whether that is populated, a valid zero or excluded for a reason.

    The fingerprint is the sum of row hashes, so it doesn't depend on order but on how often a row occurs.
    """
    every = instances.sparkSession.createDataFrame([(k, excluded.get(k)) for k in kinds], f"`{kind}` string, reason string")
    row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))
    counted = instances.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.sum(hash_key(row).cast("decimal(38,0)")).cast("string").alias("f"))
    state = F.when(F.col("reason").isNotNull(), "excluded").when(F.col("n") > 0, "populated").otherwise("valid_zero")
    return every.join(counted, kind, "left").select(kind, F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), state.alias("state"), "reason", F.coalesce("f", F.lit("0")).alias("fingerprint"))


# ---------------------------------------------------------------- the graph


def build_nodes(entities: DataFrame, definitions: DataFrame, subtypes: Mapping[str, tuple[DataFrame, Sequence[str]]], generation: str) -> DataFrame:
    """(nodeid, label, entity_type, properties, generation_id): entities that aren't quarantined, of active types, with the fields of their own subtype.

    ``subtypes`` maps a type to its table (entity_id first) and its fields; a field of several subtypes is taken from whichever
    the entity has. Unknown fields stay in the properties as nulls.
    """
    out = entities.where(~F.coalesce("is_quarantined", F.lit(False))).join(F.broadcast(definitions.where("is_active").select("entity_type", "label")), "entity_type")  # a row per type
    fields: dict[str, list[str]] = {}
    for kind, (df, names) in subtypes.items():
        side = df.select("entity_id", F.lit(kind).alias("entity_type"), *(F.col(n).cast("string").alias(f"__{kind}_{n}") for n in names))
        out = out.join(side, ["entity_id", "entity_type"], "left")
        for n in names:
            fields.setdefault(n, []).append(f"__{kind}_{n}")
    told = F.to_json(F.struct("entity_id", "entity_type", "label", *(F.coalesce(*map(F.col, cs)).alias(n) for n, cs in fields.items())), {"ignoreNullFields": "false"})
    return out.select(F.col("entity_id").alias("nodeid"), "label", "entity_type", told.alias("properties"), F.lit(generation).alias("generation_id"))


def through_lineage(df: DataFrame, lineage: DataFrame, column: str, discarded: str, kept: str, hops: int = 2) -> DataFrame:
    """``column`` replaced by what it was merged into, followed ``hops`` times; ``column``_original keeps what stood there."""
    out = df.withColumn(f"{column}_original", F.col(column))
    step = lineage.where(F.col(discarded).isNotNull()).groupBy(F.col(discarded).alias("__from")).agg(F.min(kept).alias("__to"))
    for _ in range(hops):
        out = out.join(step, F.col(column) == F.col("__from"), "left").withColumn(column, F.coalesce("__to", column)).drop("__from", "__to")
    return out


def build_edges(instances: DataFrame, lineage: DataFrame, generation: str, source: str = "source_entity_id", target: str = "target_entity_id") -> DataFrame:
    """Edges of active relationships between canonical ends, with the ends they were recorded with."""
    live = instances.where(F.col("is_active"))
    return through_lineage(through_lineage(live, lineage, source, "discarded_entity_id", "kept_entity_id"), lineage, target, "discarded_entity_id", "kept_entity_id").withColumn("generation_id", F.lit(generation))


def typed_views(nodes: DataFrame, links: DataFrame, generation: Column, node_types: Sequence[str], edge_types: Sequence[str], prefix: str = "graph") -> list[str]:
    """Registers a temporary view per node type and edge type over one generation, and one of counts; returns their names."""
    n, e = nodes.where(F.col("generation_id") == generation), links.where(F.col("generation_id") == generation)
    views = {f"{prefix}_node_{t.lower()}": n.where(F.col("entity_type") == t) for t in node_types} | {f"{prefix}_edge_{t.lower()}": e.where(F.col("relationship_type") == t) for t in edge_types}
    views[f"{prefix}_node_counts"] = n.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"))
    views[f"{prefix}_edge_counts"] = e.groupBy("relationship_type").agg(F.count(F.lit(1)).alias("n"))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
