"""Work on golden records and on runs: review decisions, merges with their log, exports, claims, resumption, routing, freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.operators import mdm


def decide(reviews: DataFrame, decisions: DataFrame, by: str = "review_id") -> DataFrame:
    """Pending reviews take the status, reviewer and time of their decision (columns verdict, reviewer, at); decided ones stay as they are.

    Several decisions of one review: the earliest counts. Decisions on unknown reviews do nothing.
    """
    d = decisions.groupBy(by).agg(F.min(F.struct("at", "verdict", "reviewer")).alias("__d"))
    hit = (F.col("status") == "pending") & F.col("__d").isNotNull()
    return reviews.join(d, by, "left").withColumns({"status": F.when(hit, F.col("__d.verdict")).otherwise(F.col("status")), "reviewed_by": F.when(hit, F.col("__d.reviewer")), "reviewed_at": F.when(hit, F.col("__d.at"))}).drop("__d")


def merge_entities(entities: DataFrame, references: DataFrame, merges: DataFrame, at: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, references, change log) after ``merges`` (keep, discard, reason): references move to the kept entity, discarded ones end at ``at``.

    An entity that several merges discard follows the least kept one. Ended entities keep the end they have.
    """
    m = merges.where(F.col("keep") != F.col("discard")).groupBy("discard").agg(F.min(F.struct("keep", "reason")).alias("m")).select("discard", "m.keep", "m.reason")
    ended = entities.join(m.select(F.col("discard").alias("entity_id"), F.lit(True).alias("__gone")), "entity_id", "left").withColumn("valid_to", F.when(F.col("__gone"), F.coalesce("valid_to", at)).otherwise(F.col("valid_to"))).drop("__gone")
    moved = references.join(m.select(F.col("discard").alias("entity_id"), "keep"), "entity_id", "left").withColumn("entity_id", F.coalesce("keep", "entity_id")).drop("keep")
    kinds = entities.select(F.col("entity_id").alias("keep"), "entity_type").distinct()
    log = m.join(kinds, "keep", "left").select(F.col("keep").alias("entity_id"), F.coalesce("entity_type", F.lit("unknown")).alias("entity_type"), F.to_json(F.struct(F.col("discard").alias("merged_from"), "reason")).alias("changed_fields"))
    return ended, moved, log


def resolve(records: DataFrame, golden: DataFrame, record: str, name: str, key: str, golden_id: str, golden_name: str, kind: str = "company") -> DataFrame:
    """(record, golden_id, score, decision): by equal identifiers first, then by names; a record without any match is in quarantine.

    Records settled by identifier are not compared by name.
    """
    exact = mdm.exact_matches(records.select(record, key).distinct(), golden.select(golden_id, key).distinct(), record, golden_id, key).groupBy(record).agg(F.min(golden_id).alias(golden_id), F.max("score").alias("score")).withColumn("decision", F.lit("auto"))
    fuzzy = mdm.fuzzy_matches(records.join(exact.select(record), record, "left_anti"), golden, record, golden_id, name, golden_name, kind)
    both = mdm.first_decision(exact.select(record, golden_id, "score", "decision"), fuzzy, by=record).drop("matcher")
    rest = records.select(record).distinct().join(both.select(record), record, "left_anti")
    return both.unionByName(rest.withColumn("decision", F.lit("quarantine")), allowMissingColumns=True)


def export_pending(log: DataFrame, domains: Mapping[str, DataFrame], at: Column, since: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(rows to write per entity type, log with what was exported marked ``at``): entries without exported_at, from ``since`` on.

    An entity that changed several times is written once. Types without a domain stay pending.
    """
    due = F.col("exported_at").isNull() & (F.lit(True) if since is None else F.col("changed_at") >= since) & F.col("entity_type").isin(*domains)
    changed = log.where(due).select("entity_id", "entity_type").distinct()
    rows = {t: df.join(changed.where(F.col("entity_type") == t).select("entity_id"), "entity_id", "left_semi") for t, df in domains.items()}
    return rows, log.withColumn("exported_at", F.when(due, at).otherwise(F.col("exported_at")))


def claim_oldest(requests: DataFrame, now: Column, owner: str, seconds: int, n: int, states: Sequence[str] = ("requested", "graph_pending")) -> DataFrame:
    """The ``n`` oldest requests that nobody holds or whose lease is over, claimed by ``owner`` for ``seconds``."""
    free = requests.where(F.col("state").isin(*states) & (F.col("claimed_by").isNull() | (F.col("lease_expires_at") < now)))
    return free.orderBy("watermark", "request_id").limit(n).withColumns({"claimed_by": F.lit(owner), "lease_expires_at": now + F.make_dt_interval(secs=F.lit(seconds)), "state": F.lit("graph_pending")})


def freshness(requests: DataFrame, now: Column, pending: Sequence[str] = ("requested", "graph_pending"), warn: int = 300, alert: int = 900) -> DataFrame:
    """(status, oldest_pending_id, oldest_age_seconds, n_pending): by the age of the oldest pending request; a backfill counts only past its deadline."""
    waits = requests.where(F.col("state").isin(*pending))
    oldest = F.min(F.struct("watermark", "request_id", "is_backfill", "backfill_deadline"))
    one = waits.agg(oldest.alias("o"), F.count(F.lit(1)).alias("n_pending"))
    age = F.unix_seconds(now) - F.unix_seconds("o.watermark")
    late = F.coalesce(now > F.col("o.backfill_deadline"), F.lit(False))
    status = F.when(F.col("o").isNull(), "normal").when(F.col("o.is_backfill"), F.when(late, "hard_alert").otherwise("normal")).when(age >= alert, "hard_alert").when(age >= warn, "warning").otherwise("normal")
    return one.select(status.alias("status"), F.col("o.request_id").alias("oldest_pending_id"), age.alias("oldest_age_seconds"), "n_pending")


def resumable(manifest: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """(key, state) of every item of a manifest: succeeded, repair_required or pending. One success settles an item whatever else was recorded."""
    o = outcomes.groupBy(key).agg(F.max(F.col("status") == "succeeded").alias("__s"), F.max(F.col("status") == "terminal_repair_required").alias("__r"))
    return manifest.select(key).where(F.col(key).isNotNull()).distinct().join(o, key, "left").select(key, F.when(F.col("__s"), "succeeded").when(F.col("__r"), "repair_required").otherwise("pending").alias("state"))


#: States of a run in the order in which they may follow (fixed values).
RUN_STATES = ["requested", "running", "succeeded", "failed"]


def run_ledger(events: DataFrame, run: str, at: str, states: Sequence[str] = tuple(RUN_STATES)) -> DataFrame:
    """(run, state, started_at, finished_at, n_events): every run at the furthest state it reached, whatever order its events come in."""
    place = F.array_position(F.array(*map(F.lit, states)), F.col("state"))
    return events.where(place > 0).groupBy(run).agg(F.max(F.struct(place.alias("p"), F.col("state").alias("s"))).alias("m"), F.min(F.when(F.col("state") == "running", F.col(at))).alias("started_at"), F.max(F.when(F.col("state").isin("succeeded", "failed"), F.col(at))).alias("finished_at"), F.count(F.lit(1)).alias("n_events")).select(run, F.col("m.s").alias("state"), "started_at", "finished_at", "n_events")


def band_of(key: Column, bands: Sequence[tuple[int, int]]) -> Column:
    """The number of the closed range that holds a key; NULL outside all."""
    out = F.lit(None).cast("int")
    for i, (low, high) in reversed(list(enumerate(bands))):
        out = F.when(key.between(low, high), i).otherwise(out)
    return out


def route(direct: Mapping[str, tuple[DataFrame, str]], joined: Mapping[str, tuple[DataFrame, DataFrame, str, str]], everywhere: Mapping[str, DataFrame], bands: Sequence[tuple[int, int]]) -> dict[str, DataFrame]:
    """Every table with its ``band``: by its own key, by the key of what it refers to (one row per reference), or, small ones, in all bands."""
    out = {n: df.withColumn("band", band_of(F.col(k), bands)).where("band IS NOT NULL") for n, (df, k) in direct.items()}
    for n, (df, other, ref, k) in joined.items():
        at = other.where(F.col(ref).isNotNull()).groupBy(ref).agg(F.min(k).alias("__k"))
        out[n] = df.join(at, ref).withColumn("band", band_of(F.col("__k"), bands)).where("band IS NOT NULL").drop("__k")
    copies = F.explode(F.sequence(F.lit(0), F.lit(len(bands) - 1)))
    return out | {n: df.withColumn("band", copies) for n, df in everywhere.items()}


def shard_report(shards: DataFrame, shard: str, key: Sequence[str], at: str) -> DataFrame:
    """(shard, n_rows, n_keys, last_at, rows_off, behind): every shard against the largest and the latest of all."""
    g = shards.groupBy(shard).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*key).alias("n_keys"), F.max(at).alias("last_at"))
    top = g.agg(F.max("n_rows").alias("__n"), F.max("last_at").alias("__at"))
    return g.crossJoin(F.broadcast(top)).select(shard, "n_rows", "n_keys", "last_at", (F.col("__n") - F.col("n_rows")).alias("rows_off"), (F.col("last_at") < F.col("__at")).alias("behind"))  # one row
