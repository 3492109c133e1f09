"""Queries of the text and matching problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.llm import abuse, linkage, mixing, names, packing, tokens
from cairnflow.session import cut, table

# ---------------------------------------------------------------- firms and advisers


def _firms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    firms = table(spark, d, "mdm_company").select(F.col("entity_id").alias("entity"), F.col("canonical_name").alias("name"), linkage.place_code(F.col("state_of_incorporation")).alias("place"), F.col("valid_to").isNull().alias("active"))
    funds = table(spark, d, "sec_adv_private_fund").where(F.col("adviser_crd_number").isNotNull())
    filings = table(spark, d, "sec_adv_filing").where(F.col("crd_number").isNotNull())
    told = filings.select(F.col("crd_number").alias("query"), F.lit("own").alias("kind"), F.col("adviser_name").alias("text")).unionByName(funds.select(F.col("adviser_crd_number").alias("query"), F.lit("part").alias("kind"), F.col("fund_name").alias("text")))
    lain = funds.select(F.col("adviser_crd_number").alias("query"), "private_fund_id", linkage.place_code(F.col("jurisdiction")).alias("place")).where(F.col("place").isNotNull()).distinct().groupBy("query", "place").agg(F.count(F.lit(1)).alias("n"))
    return firms, told, lain


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of firm and adviser with cosine, log odds and confidence."""
    return linkage.match_records(*_firms(spark, d)).withColumnsRenamed({"entity": "entity_id", "query": "adviser_crd_number"})


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("entity_id", "adviser_crd_number")


# ---------------------------------------------------------------- variant spellings


def _registrations(spark: SparkSession, d: str) -> DataFrame:
    """(kind, record, name, mark): every name of every cik, and of every fund."""
    company = table(spark, d, "sec_company").where(F.col("cik").isNotNull())
    facts = company.groupBy("cik").agg(F.max("ein").alias("mark"), F.max(F.col("sic").isNotNull() | F.col("ein").isNotNull() | F.coalesce(F.col("entity_type") == "operating", F.lit(False))).alias("firm"))
    called = company.select("cik", F.col("entity_name").alias("name")).unionByName(table(spark, d, "sec_company_former_name").select("cik", F.col("former_name").alias("name"))).where(F.col("cik").isNotNull() & F.col("name").isNotNull()).distinct()
    ciks = called.join(facts, "cik", "left").select(F.when(F.coalesce("firm", F.lit(True)), "organisation").otherwise("person").alias("kind"), F.concat(F.lit("CIK"), F.lpad(F.col("cik").cast("string"), 10, "0")).alias("record"), "name", "mark")
    funds = table(spark, d, "sec_adv_private_fund").where(F.col("private_fund_id").isNotNull() & F.col("fund_name").isNotNull()).select(F.lit("fund").alias("kind"), F.col("private_fund_id").alias("record"), F.col("fund_name").alias("name"), F.lit(None).cast("string").alias("mark")).distinct()
    return ciks.unionByName(funds)


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per registration that has a variant, with its group."""
    return names.link_names(_registrations(spark, d)).select("kind", F.col("record").alias("record_key"), F.col("group").alias("group_key"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = names.group_pairs(names.link_names(_registrations(spark, d)))
    return pairs.select(F.when(F.col("kind") == "fund", "fund").otherwise("company").alias("record_kind"), "key_a", "key_b").distinct()


# ---------------------------------------------------------------- containers


def _sized(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    """Token counts of all documents, counted once and written for the branches that read them."""
    docs = table(spark, d, "documents").where(F.col("doc_id").isNotNull())
    return cut(tokens.with_tokens(docs, ["doc_id", *keep]).dropDuplicates(["doc_id"]))


def _specs(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    rows = table(spark, d, "container_spec").where("spec_name IS NOT NULL AND capacity_tokens > 0").select("spec_name", "capacity_tokens").distinct()
    return sorted((r[0], r[1]) for r in rows.collect())  # a handful of named sizes


def _packed(spark: SparkSession, d: str) -> list[tuple[str, int, DataFrame]]:
    sized = _sized(spark, d)
    return [(name, capacity, packing.pack(sized, "doc_id", "n_tokens", capacity)) for name, capacity in _specs(spark, d)]


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document or piece under every spec."""
    out = None
    for name, _, packed in _packed(spark, d):
        one = packed.withColumn("spec_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def p8_fills(spark: SparkSession, d: str) -> DataFrame:
    """The fill of every container under every spec."""
    out = None
    for name, capacity, packed in _packed(spark, d):
        one = packing.fills(packed, capacity).withColumn("spec_name", F.lit(name)).withColumn("capacity_tokens", F.lit(capacity))
        out = one if out is None else out.unionByName(one)
    return out


def p8_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per spec: containers, tokens, the fill reached, and the least number of containers that could do."""
    rows = p8_fills(spark, d).groupBy("spec_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n_pieces").alias("n_pieces"), F.sum("used").alias("tokens"))
    return rows.withColumn("fill", F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity_tokens")))


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per spec: documents placed, containers beyond their capacity, documents that lost or gained a token, and documents split although they fit."""
    sized = _sized(spark, d)
    out = None
    for name, capacity in _specs(spark, d):
        packed = cut(packing.pack(sized, "doc_id", "n_tokens", capacity))
        over = packing.fills(packed, capacity).agg(F.count_if(F.col("used") > capacity).cast("long").alias("overfull"))
        docs = packed.groupBy("doc_id").agg(F.sum("length").alias("length"), F.count(F.lit(1)).alias("pieces")).join(sized, "doc_id", "full")
        told = docs.agg(F.count("length").alias("n_documents"), F.count_if(~F.col("length").eqNullSafe(F.col("n_tokens"))).cast("long").alias("torn"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= capacity)).cast("long").alias("split_needlessly"))
        one = told.crossJoin(over).withColumn("spec_name", F.lit(name)).withColumn("capacity_tokens", F.lit(capacity).cast("long"))  # one row each
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- mixture


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sized = _sized(spark, d, "source")
    targets = table(spark, d, "mix_target")
    return mixing.choose(sized, targets, "doc_id", "source", "n_tokens"), sized, targets


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents with their repeats, in order by slot and offset."""
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per source the share aimed at and the share reached."""
    chosen, sized, targets = _mixture(spark, d)
    return mixing.shares(cut(chosen), sized, targets, "source", "n_tokens", "doc_id")


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target with a supply: documents used beyond the cap, copies missing below one in use, rows of another source, and whether the mix is as large as its supply or all caps are reached."""
    chosen, sized, targets = _mixture(spark, d)
    chosen = cut(chosen)
    used = chosen.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("top"))
    goal = targets.where(F.col("source").isNotNull() & (F.col("target_share") > 0)).groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", F.col("t.max_repeats").alias("max_repeats")).where("max_repeats > 0")
    held = used.join(sized.select("doc_id", F.col("source").alias("own")), "doc_id").join(goal, "source")
    told = held.groupBy("source").agg(F.count_if(F.col("n") > F.col("max_repeats")).cast("long").alias("over_cap"), F.count_if(F.col("n") != F.col("top")).cast("long").alias("gaps"), F.count_if(~F.col("own").eqNullSafe(F.col("source"))).cast("long").alias("foreign"))
    supply = sized.join(goal, "source").groupBy("source", "max_repeats").agg(F.sum("n_tokens").alias("n")).where("n > 0")
    got = chosen.groupBy("source").agg(F.sum("n_tokens").alias("g"))
    filled = supply.join(got, "source", "left").agg(((F.sum("g") >= F.sum("n")) | (F.count_if(F.coalesce("g", F.lit(0)) < F.col("n") * F.col("max_repeats")) == 0)).alias("filled"))
    return told.crossJoin(filled)  # one row


# ---------------------------------------------------------------- unfit content


def _scored(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("doc_id").isNotNull())
    lm = abuse.language_model(abuse.ngram_counts(docs), abuse.LEXICON)
    return abuse.score_documents(docs, ["doc_id", "source"], lm, abuse.learn(docs, table(spark, d, "review_label"), lm))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where(F.col("score") >= 0.5).select("doc_id").distinct()


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document's score, main kind, and the probability that a reviewer, who errs at times, would flag it."""
    return _scored(spark, d).withColumn("flag_probability", F.lit(abuse.MISTAKES) + (1 - 2 * abuse.MISTAKES) * F.col("score"))


def p10_source_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.source_rates(_scored(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p6_found, p6_groups, p8_containers, p8_fills, p8_summary, p8_invariants, p9_mix, p9_shares, p9_invariants, p10_found, p10_scores, p10_source_rates)}
#: Packing and mixing depend on a tokenizer, which SQL lacks; what must hold of any result is checked instead.
SQL: dict[str, str] = {
    "p8_invariants": """SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS n_documents, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS split_needlessly, spec_name, CAST(capacity_tokens AS BIGINT) AS capacity_tokens FROM (SELECT DISTINCT spec_name, capacity_tokens FROM container_spec WHERE spec_name IS NOT NULL AND capacity_tokens > 0)""",
    "p9_invariants": """SELECT source, CAST(0 AS BIGINT) AS over_cap, CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS "foreign", true AS filled FROM (SELECT source, arg_max(max_repeats, (target_share, max_repeats)) AS r FROM mix_target WHERE source IS NOT NULL AND target_share > 0 GROUP BY 1) WHERE r > 0 AND source IN (SELECT source FROM documents WHERE doc_id IS NOT NULL AND text <> '')""",
}
