"""Mixing sources to target weights.

The mix has a size in tokens. Each source gets its share of it as a quota and fills it with
whole documents, repeated at most a capped number of times; what a source can't fill, the
others take over in proportion. Quotas are cut into blocks; Pfair release times and
deadlines, taken earliest deadline first, interleave the blocks so that no source is ever a
whole block ahead of or behind its share.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.operators.ranks import spread_sums

#: Slots of one round of the schedule, made on the driver; the rounds repeat, so it doesn't grow with the data.
PERIOD = 2_000
#: Tokens that a block holds at most on average, whatever the size of the mix.
BLOCK_TOKENS = 4_096


def quotas(supply: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens for each source that has a supply and a positive target; ``total`` is the size of the mix, by default all their supply.

    A source whose cap holds it below its share gives all it may, and the rest goes to the others in proportion, so
    the quotas add up to ``total`` at least unless all sources are at their caps. Sources without supply reach nothing.
    """
    usable = {s: (Fraction(w).limit_denominator(10**9), cap) for s, (w, cap) in targets.items() if w and w > 0 and (cap or 0) > 0 and supply.get(s, 0) > 0}
    left = Fraction(sum(supply[s] for s in usable) if total is None else max(0, total))
    out: dict[str, int] = {}
    while usable and left > 0:
        whole = sum(w for w, _ in usable.values())
        full = {s for s, (w, cap) in usable.items() if supply[s] * cap <= left * w / whole}
        for s in full or usable:
            out[s] = supply[s] * usable[s][1] if full else -(-left * usable[s][0] // whole)
        left = left - sum(out[s] for s in full) if full else Fraction(0)
        usable = {s: x for s, x in usable.items() if s not in full}
    return {s: int(q) for s, q in out.items() if q > 0}


def round_counts(quota: dict[str, int], period: int = PERIOD) -> dict[str, int]:
    """Blocks of every source in one round: in proportion to the quotas by largest remainders, one at least."""
    total = sum(quota.values())
    out = {s: max(1, q * period // total) for s, q in quota.items()}
    spare = sorted(quota, key=lambda s: (-(quota[s] * period % total), s))
    for s in spare[: max(0, period - sum(out.values()))]:
        out[s] += 1
    return out


def pfair(blocks: dict[str, int]) -> list[tuple[str, int]]:
    """(source, block) of every slot: block k of a source with n of N blocks is released at kN/n and due at (k+1)N/n.

    Earliest deadline first among the released; ties by successor bit, then by name. Whole numbers only.
    """
    total = sum(blocks.values())
    due = lambda s, k: -(-(k + 1) * total // blocks[s])
    waiting = [(0, s, 0) for s, n in sorted(blocks.items()) if n]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            overlaps = (k + 1) * total % blocks[s] != 0  # the next block's window begins before this one ends
            heapq.heappush(ready, (due(s, k), 0 if overlaps else 1, s, k))
        _, _, s, k = heapq.heappop(ready)
        out.append((s, k))
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, ((k + 1) * total // blocks[s], s, k + 1))
    return out


def choose(items: DataFrame, targets: DataFrame, item: str, source: str, size: str, target_source: str = "source", share: str = "target_share", cap: str = "max_repeats", total: int | None = None, block_tokens: int = BLOCK_TOKENS, period: int = PERIOD) -> DataFrame:
    """(item, source, copy, size, offset, block, slot): the chosen documents in the order of the mix by slot, offset.

    ``items`` should be cheap to read several times. Documents of NULL source or of no target are not chosen; empty
    ones neither. ``total`` as in quotas(). Copies are whole passes over the source, then a last part of the pass, so no
    document is used more than the cap. The order within a source is by a hash of the item,
    the same on every run. A source's quota is exceeded by less than its last document, and a document belongs to the
    block in which it begins. Several targets of one source count once, the greatest. No usable target gives no row.
    """
    known = targets.where(F.col(target_source).isNotNull()).groupBy(target_source).agg(F.max(F.struct(share, cap)).alias("t"))
    wanted = {r[0]: (r["t"][0] or 0.0, r["t"][1] or 0) for r in known.collect()}  # one row per target
    usable = items.where(F.col(source).isin(*wanted) & (F.col(size) > 0)) if wanted else items.where("false")
    supply = {r[0]: r["n"] for r in usable.groupBy(source).agg(F.sum(size).alias("n")).collect()}  # one row per target
    quota = quotas(supply, wanted, total)
    spark = items.sparkSession
    # Every round has the same blocks; a source's blocks are equal parts of its quota, so all quotas end together.
    rounds = max(1, -(-sum(quota.values()) // (period * block_tokens)))
    counts = round_counts(quota, period) if quota else {}
    slots = spark.createDataFrame([(s, k, slot) for slot, (s, k) in enumerate(pfair(counts))], f"`{source}` string, __k bigint, __slot bigint")
    plan = spark.createDataFrame([(s, q, supply[s], counts[s]) for s, q in quota.items()], f"`{source}` string, __quota bigint, __supply bigint, __count bigint")
    # Order within a source: by content hash, spread over many tasks even if one source holds most rows.
    placed = spread_sums(usable.select(item, source, size), [source], [item], F.col(size).cast("long"), 64, "__before")
    passes = placed.join(F.broadcast(plan), source)  # one row per target
    copies = passes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__quota") - 1) / F.col("__supply")).cast("long"))))
    chosen = copies.withColumn("offset", F.col("copy") * F.col("__supply") + F.col("__before")).where(F.col("offset") < F.col("__quota"))
    block = F.expr(f"cast(cast(offset as decimal(25,0)) * cast(__count * {rounds} as decimal(12,0)) div cast(__quota as decimal(25,0)) as bigint)")
    chosen = chosen.withColumn("block", block).withColumn("__k", F.col("block") % F.col("__count"))
    slot = F.expr("block div __count") * sum(counts.values()) + F.col("__slot")
    return chosen.join(F.broadcast(slots), [source, "__k"]).select(item, source, (F.col("copy") + 1).alias("copy"), F.col(size), "offset", "block", slot.alias("slot"))  # at most period + one per target rows


def shares(chosen: DataFrame, items: DataFrame, targets: DataFrame, source: str, size: str, item: str) -> DataFrame:
    """Per source of either side: target share, supply, what was chosen, the share reached, the shortfall against the target, and the greatest number of repeats."""
    total = chosen.agg(F.sum(size).alias("__total"))
    got = chosen.groupBy(source).agg(F.count(F.lit(1)).alias("n_chosen"), F.countDistinct(item).alias("n_documents"), F.sum(size).alias("chosen_tokens"), F.max("copy").alias("most_repeats"))
    have = items.groupBy(source).agg(F.count(F.lit(1)).alias("supply_documents"), F.sum(size).alias("supply_tokens"))
    goal = targets.groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select(F.col("source").alias("__s"), F.col("t.target_share").alias("target_share"), F.col("t.max_repeats").alias("max_repeats"))
    both = have.join(goal, have[source].eqNullSafe(goal["__s"]), "full").withColumn("__source", F.coalesce(source, "__s")).drop(source, "__s")
    joined = both.join(got, both["__source"].eqNullSafe(got[source]), "left").drop(source).crossJoin(F.broadcast(total))  # one row
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        F.col("__source").alias(source), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "max_repeats", *(zero(c) for c in ("supply_documents", "supply_tokens", "n_chosen", "n_documents", "chosen_tokens", "most_repeats")),
        F.when(F.col("__total") > 0, F.coalesce(F.col("chosen_tokens"), F.lit(0)) / F.col("__total")).alias("actual_share"),
        F.greatest(F.round(F.coalesce("target_share", F.lit(0.0)) * F.coalesce("__total", F.lit(0))).cast("long") - F.coalesce("chosen_tokens", F.lit(0)), F.lit(0)).cast("long").alias("missing_tokens"),
    )
