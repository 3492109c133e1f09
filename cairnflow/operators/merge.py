"""Keyed merges: last write wins, first/last splits, coalescing updates, and merges by authority.

One generic merge driven by a table specification. Each kind is one aggregation or one full
join on the key; rows of one key are reduced on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MergeSpec:
    """How a table collapses: its key, what the first row decides, what NULL can't clobber, who has authority, what isn't compared."""

    key: tuple[str, ...]
    first: tuple[str, ...] = ()
    coalesce: tuple[str, ...] = ()
    authority: str | None = None
    provenance: tuple[str, ...] = field(default=("last_sync_run_id",))


#: Specifications of the filing tables (fixed values).
SPECS = {
    "sec_company": MergeSpec(("cik",), authority="last_synced_at", provenance=("last_sync_run_id", "mdm_entity_id")),
    "sec_company_address": MergeSpec(("cik", "address_type"), authority="last_synced_at"),
    "sec_company_former_name": MergeSpec(("cik", "ordinal")),
    "sec_company_filing": MergeSpec(("accession_number",), first=("cik", "act", "file_number", "film_number", "items"), authority="last_synced_at"),
    "sec_company_ticker": MergeSpec(("cik", "ticker", "source_name"), authority="last_synced_at"),
    "sec_adv_filing": MergeSpec(("accession_number",), provenance=("last_sync_run_id", "mdm_entity_id")),
    "sec_adv_private_fund": MergeSpec(("accession_number", "fund_index"), provenance=("last_sync_run_id", "mdm_entity_id")),
    "sec_financial_fact": MergeSpec(("cik", "accession_number", "concept", "fiscal_period", "segment", "period_end", "period_start"), first=("fiscal_year", "form_type", "unit"), authority="ingested_at"),
    "sec_financial_derived": MergeSpec(("cik", "accession_number", "fiscal_period", "period_end"), first=("fiscal_year", "form_type"), authority="ingested_at"),
    "sec_accounting_flag": MergeSpec(("cik", "accession_number"), coalesce=("*",), authority="ingested_at"),
    "sec_executive_record": MergeSpec(("cik", "accession_number", "exec_name"), authority="ingested_at"),
    "sec_thirteenf_holding": MergeSpec(("cik", "accession_number", "holding_index"), authority="ingested_at"),
    "sec_thirteenf_filing": MergeSpec(("accession_number",), authority="ingested_at"),
}


def collapse(log: DataFrame, spec: MergeSpec, seq: str) -> DataFrame:
    """One row per key of a landing log by ``seq``: last row wins, ``first`` columns from the first row, ``coalesce`` columns from the last row that has them.

    Ties in ``seq`` go to the greatest content. A NULL key is a key of its own; an empty log gives no row.
    """
    columns = [c for c in log.columns if c not in spec.key and c != seq]
    kept = [c for c in columns if "*" in spec.coalesce or c in spec.coalesce]
    first = [c for c in columns if c in spec.first]
    last = [c for c in columns if c not in kept and c not in first]
    aggregates = [F.max(F.col(seq)).alias(seq)]
    if last:
        aggregates.append(F.max(F.struct(F.col(seq).alias("s"), *last)).alias("__last"))
    if first:
        aggregates.append(F.min(F.struct(F.col(seq).alias("s"), *first)).alias("__first"))
    aggregates += [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("s"), F.col(c).alias("v")))).alias(f"__keep_{c}") for c in kept]
    rows = log.groupBy(*spec.key).agg(*aggregates)
    value = {c: F.col(f"__last.{c}") for c in last} | {c: F.col(f"__first.{c}") for c in first} | {c: F.col(f"__keep_{c}.v") for c in kept}
    return rows.select(*spec.key, seq, *(value[c].alias(c) for c in columns))


def essential(log: DataFrame, spec: MergeSpec, seq: str) -> DataFrame:
    """The rows of a log that its collapse rests on: per key the first, the last, and the last known of each coalesced column.

    collapse(essential(a) + b) equals collapse(a + b) whatever order rows arrive in, so this is all a stream must keep.
    """
    columns = [c for c in log.columns if c not in spec.key]
    row = F.struct(F.col(seq).alias("__s"), *columns)
    kept = [c for c in columns if c != seq and ("*" in spec.coalesce or c in spec.coalesce)]
    picks = [F.max(row), F.min(row), *(F.max(F.when(F.col(c).isNotNull(), row)) for c in kept)]
    grouped = log.groupBy(*spec.key).agg(*(p.alias(f"__p{i}") for i, p in enumerate(picks)))
    rows = grouped.select(*spec.key, F.explode(F.array_distinct(F.array_compact(F.array(*(F.col(f"__p{i}") for i in range(len(picks))))))).alias("r"))
    return rows.select(*spec.key, *(F.col(f"r.{c}").alias(c) for c in columns)).select(*log.columns)


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], insert_only: bool = False) -> DataFrame:
    """Rows of ``batch`` replace those of ``target`` with their key; with ``insert_only`` existing keys stay as they are.

    The batch must have one row per key (collapse it first). Columns missing on a side are NULL.
    """
    winner, other = (target, batch) if insert_only else (batch, target)
    rest = other.join(winner.select(*key), list(key), "left_anti")
    return winner.unionByName(rest, allowMissingColumns=True)


def merge_matched(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Matched rows take all non-key values of the batch, others are inserted or stay; by one full join."""
    columns = [c for c in target.columns if c not in key]
    b = batch.select(*key, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__b_{c}") for c in columns))
    joined = target.join(b, list(key), "full")
    return joined.select(*key, *(F.when(F.col("__hit"), F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c) for c in columns))


def replace_scope(target: DataFrame, batch: DataFrame, scope: Sequence[str]) -> DataFrame:
    """All rows of the scopes named in ``batch`` are replaced by its rows."""
    return target.join(batch.select(*scope).distinct(), list(scope), "left_anti").unionByName(batch)


def authority_merge(canonical: DataFrame, candidate: DataFrame, spec: MergeSpec) -> DataFrame:
    """Both sides' rows of every key with the outcome: new, kept, same, candidate or conflict.

    Equal content (NULL-safe, without key, provenance and authority) leaves the canonical row whole. Else the
    strictly greater authority wins; a tie or a NULL authority is a conflict, and the caller must abort.
    Where the candidate wins, a NULL mdm_entity_id keeps the canonical value. Columns only the candidate has are
    added and, like those only the canonical has, not compared. Each side has one row per key.
    """
    extra = [c for c in candidate.columns if c not in canonical.columns]
    columns = [c for c in canonical.columns if c not in spec.key] + extra
    a = canonical.select(*spec.key, F.lit(True).alias("__a"), *(F.col(c).alias(f"__a_{c}") if c in canonical.columns else F.lit(None).cast(dict(candidate.dtypes)[c]).alias(f"__a_{c}") for c in columns))
    b = candidate.select(*spec.key, F.lit(True).alias("__b"), *(F.col(c).alias(f"__b_{c}") if c in candidate.columns else F.lit(None).cast(dict(canonical.dtypes)[c]).alias(f"__b_{c}") for c in columns))
    compared = [c for c in columns if c not in spec.provenance and c != spec.authority and c in canonical.columns and c in candidate.columns]
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))
    if spec.authority:
        x, y = F.col(f"__a_{spec.authority}"), F.col(f"__b_{spec.authority}")
        judged = F.when(y > x, "candidate").when(x > y, "kept").otherwise("conflict")
    else:
        judged = F.lit("conflict")
    outcome = F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "kept").when(same, "same").otherwise(judged)
    joined = a.join(b, list(spec.key), "full").withColumn("outcome", outcome)
    wins = F.col("outcome").isin("new", "candidate")
    value = lambda c: F.when(wins, F.coalesce(F.col(f"__b_{c}"), F.col(f"__a_{c}")) if c == "mdm_entity_id" else F.col(f"__b_{c}")).otherwise(F.col(f"__a_{c}")).alias(c)
    return joined.select(*spec.key, *(value(c) for c in columns), "outcome")


def settled(merged: DataFrame) -> DataFrame:
    """The merged table; raises if any key is in conflict, naming how many."""
    conflicts = merged.where(F.col("outcome") == "conflict").count()
    if conflicts:
        raise ValueError(f"{conflicts} keys differ without a greater authority")
    return merged.drop("outcome")


def table_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, digest): an order-free digest of the rows as a multiset: the sum of 63-bit row hashes, exact as a decimal."""
    from cairnflow.functions.keys import hash_key

    columns = sorted(columns or df.columns)
    row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))
    return df.select(hash_key(row).alias("h")).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons): a rule names what is wrong where its condition holds; NULL counts as not."""
    reasons = F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in rules.items())))
    judged = df.withColumn("reasons", reasons)
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)
