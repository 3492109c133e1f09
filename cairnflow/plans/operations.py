"""Queries of ingestion and operation: further readers, golden-record work, ledgers, routing, resumption, dimensions."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.functions import keys as K
from cairnflow.functions import text as T
from cairnflow.operators import mdm, merge
from cairnflow.operators import relational as R
from cairnflow.operators import stewardship as W
from cairnflow.plans.registry import Query, registrar
from cairnflow.session import shared_folder, table
from cairnflow.sources import readers, writers

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

# ---------------------------------------------------------------- readers


def _submissions(spark: SparkSession, d: str) -> DataFrame:
    """Customers as registrants' JSON: two addresses, up to two former names, a further file, some parts missing."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    address = lambda t: F.struct(F.concat(F.lit(t), k).alias("street1"), F.lit("NY").alias("stateOrCountry"))
    former = F.when(F.col("c_custkey") % 3 > 0, F.array(F.struct(F.concat(F.lit("old "), "c_name").alias("name"), F.lit("2020-01-02T00:00:00Z").alias("date")), F.struct(F.concat(F.lit("older "), "c_name").alias("name"), F.lit("never").alias("date"))))
    files = F.array(F.struct(F.concat(F.lit("f"), k).alias("name"), F.col("c_custkey").alias("filingCount"), F.lit("2001-01-01").alias("filingFrom")), F.struct(F.lit("").alias("name"), F.lit(1).cast("bigint").alias("filingCount"), F.lit(None).cast("string").alias("filingFrom")))
    body = F.struct(F.col("c_name").alias("name"), F.lit("operating").alias("entityType"), F.create_map(F.lit("mailing"), address("m"), F.lit("business"), address("b")).alias("addresses"), former.alias("formerNames"), F.struct(files.alias("files")).alias("filings"))
    return c.select(F.col("c_custkey").alias("cik"), F.to_json(body).alias("payload"))


@query("SELECT c_custkey AS cik, 'company' AS part, c_name AS a, 'operating' AS b, 0 AS n FROM customer UNION ALL SELECT c_custkey, 'address', t, t[1] || c_custkey, 0 FROM customer, (SELECT unnest(['mailing', 'business']) AS t) UNION ALL SELECT c_custkey, 'former_name', p || c_name, d, i FROM customer, (VALUES ('old ', '2020-01-02', 1), ('older ', NULL, 2)) f(p, d, i) WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'manifest', 'f' || c_custkey, '2001-01-01', c_custkey FROM customer")
def src_submissions(spark, d):
    """Company, addresses, former names and further files out of one JSON each."""
    t = readers.submissions(_submissions(spark, d), "payload", ["cik"])
    one = lambda part, a, b, n: t[part].select("cik", F.lit(part).alias("part"), a.alias("a"), b.cast("string").alias("b"), n.cast("long").alias("n"))
    zero, c = F.lit(0), F.col
    return one("company", c("entity_name"), c("entity_type"), zero).unionByName(one("address", c("address_type"), c("street1"), zero)).unionByName(one("former_name", c("former_name"), c("date_changed"), c("ordinal"))).unionByName(one("manifest", c("file_name"), c("filing_from"), c("filing_count")))


@query("SELECT user_id, CAST(event_id AS BIGINT) AS id, event_type AS kind FROM events")
def src_paginated(spark, d):
    """Pages of parallel arrays under a member of the JSON, a page per user."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("a"))
    page = F.to_json(F.struct(F.struct(F.struct(F.col("a.event_id").alias("id"), F.col("a.event_type").alias("kind")).alias("recent")).alias("filings")))
    return readers.parallel_arrays(e.select("user_id", page.alias("p")), "p", {"id": "bigint", "kind": "string"}, ["user_id"], "$.filings.recent").drop("ordinal")


@query("SELECT c_custkey AS accession, CASE WHEN c_custkey % 2 = 0 THEN 'Firm ' || c_nationkey END AS auditor_name, CAST(c_nationkey AS VARCHAR) AS auditor_pcaob_id, NULL::VARCHAR AS auditor_location, CASE WHEN c_custkey % 5 = 0 THEN 'true' END AS icfr_attestation FROM customer WHERE c_custkey % 4 < 3")
def src_auditor_facts(spark, d):
    c = table(spark, d, "customer")
    form = F.when(F.col("c_custkey") % 4 < 3, "10-K").otherwise("10-Q")
    fact = lambda name, v: F.struct(F.lit(name).alias("concept"), v.alias("value"))
    facts = F.array(fact("AuditorName", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" Firm "), F.col("c_nationkey").cast("string")))), fact("AuditorFirmId", F.col("c_nationkey").cast("string")), fact("IcfrAuditorAttestationFlag", F.when(F.col("c_custkey") % 5 == 0, "true")), fact("EntityCentralIndexKey", F.lit("x")))
    rows = c.select(F.col("c_custkey").alias("accession"), form.alias("form"), F.explode(facts).alias("f")).select("accession", "form", "f.concept", "f.value", F.lit(1).alias("at"))
    return readers.auditor_facts(rows.withColumn("accession", F.col("accession").cast("string")), "accession", "concept", "form", "value", "at").withColumn("accession", F.col("accession").cast("long"))


@query("SELECT s_suppkey AS id, s_suppkey % 3 > 0 AS is_amendment, CASE s_suppkey % 3 WHEN 1 THEN 'restatement' WHEN 2 THEN 'added_holdings' END AS amendment_type, s_suppkey % 2 = 0 AS confidential_omission, DATE '2022-09-30' AS period_of_report FROM supplier")
def src_thirteenf_cover(spark, d):
    k = F.col("s_suppkey")
    period = F.when(k % 2 == 0, "09-30-2022").otherwise("2022-09-30")
    xml = F.concat(F.lit("<ns1:edgarSubmission xmlns:ns1='x'><ns1:periodOfReport>"), period, F.lit("</ns1:periodOfReport><isAmendment>"), F.when(k % 3 > 0, "true").otherwise("false"), F.lit("</isAmendment><amendmentInfo><amendmentType>"), F.when(k % 3 == 1, "RESTATEMENT").when(k % 3 == 2, "New Holdings").otherwise(""), F.lit("</amendmentType></amendmentInfo><confidentialOmitted>"), F.when(k % 2 == 0, "1").otherwise("0"), F.lit("</confidentialOmitted></ns1:edgarSubmission>"))
    return table(spark, d, "supplier").select(k.alias("id"), readers.thirteenf_cover(xml).alias("c")).select("id", "c.*")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN s > 1 AND l_extendedprice <> 0 AND abs(l_extendedprice) < s THEN NULL ELSE l_extendedprice END AS amount FROM (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 20000 END AS s FROM lineitem)")
def src_plausible_amounts(spark, d):
    s = F.when(F.col("l_linenumber") % 3 == 0, 1).when(F.col("l_linenumber") % 3 == 1, 20000)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", readers.plausible_amount(F.col("l_extendedprice"), s).alias("amount"))


@query("SELECT c_custkey AS cik, 'T' || c_custkey AS ticker, c_mktsegment AS exchange, row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) AS source_rank FROM customer")
def src_tickers(spark, d):
    """Tickers of JSON files of fields and rows, fifty a file, with their rank in it."""
    c = table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 50)).agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_mktsegment"))).alias("a"))
    body = F.to_json(F.struct(F.array(F.lit("cik"), F.lit("ticker"), F.lit("exchange")).alias("fields"), F.transform("a", lambda x: F.array(x["c_custkey"].cast("string"), F.concat(F.lit("T"), x["c_custkey"].cast("string")), x["c_mktsegment"])).alias("data")))
    r = readers.ticker_rows(c.select(body.alias("p")), "p")
    return r.select(F.col("row")["cik"].cast("long").alias("cik"), F.col("row")["ticker"].alias("ticker"), F.col("row")["exchange"].alias("exchange"), F.col("source_rank").cast("long").alias("source_rank"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_checked_csv(spark, d):
    """A compressed CSV written and read back under a schema; repeated rows collapse, keys whose rows differ would raise."""
    path = os.path.join(shared_folder(spark).replace("file:///", "/"), f"query-{uuid.uuid4().hex}")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    c.unionByName(c).write.csv(path, header=True, compression="gzip")
    return readers.csv_checked(spark, path, "c_custkey long, c_name string, c_acctbal double", ["c_custkey"])


@query("SELECT s_suppkey AS k, concat_ws(',', CASE WHEN s_acctbal < 0 THEN 'negative' END, CASE WHEN s_nationkey > 20 THEN 'no nation' END) AS reasons FROM supplier")
def src_manual_rows(spark, d):
    """Rows of a manual CSV, each valid or with all reasons against it."""
    s = table(spark, d, "supplier")
    good, bad = merge.split_rejects(s, {"negative": F.col("s_acctbal") < 0, "no nation": F.col("s_nationkey") > 20})
    return good.select(F.col("s_suppkey").alias("k"), F.lit("").alias("reasons")).unionByName(bad.select(F.col("s_suppkey").alias("k"), F.array_join("reasons", ",").alias("reasons")))


@query("SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer")
def snk_checked(spark, d):
    """Two tables published as one after their counts agree with the manifest."""
    folder = os.path.join(shared_folder(spark).replace("file:///", "/"), f"query-{uuid.uuid4().hex}")
    t = {n: table(spark, d, n) for n in ("orders", "customer")}
    writers.publish_checked(t, {n: df.count() for n, df in t.items()}, folder, "g1")
    one = lambda n: writers.published_table(spark, folder, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
    return one("orders").unionByName(one("customer"))


# ---------------------------------------------------------------- golden records

_PAIRED = "SELECT l_orderkey AS review_id, l_partkey AS entity_id_a, l_suppkey AS entity_id_b, CASE WHEN l_orderkey % 4 = 0 THEN 'accepted' ELSE 'pending' END AS status FROM lineitem WHERE l_linenumber = 1"


@query(f"SELECT review_id, CASE WHEN status = 'pending' AND review_id % 3 = 0 THEN CASE WHEN review_id % 2 = 0 THEN 'accepted' ELSE 'rejected' END ELSE status END AS status, CASE WHEN status = 'pending' AND review_id % 3 = 0 THEN 'r1' END AS reviewed_by FROM ({_PAIRED})")
def md_reviews(spark, d):
    """Decisions on every third review; only pending ones take them."""
    l = table(spark, d, "lineitem").where("l_linenumber = 1")
    r = l.select(F.col("l_orderkey").alias("review_id"), F.when(F.col("l_orderkey") % 4 == 0, "accepted").otherwise("pending").alias("status"))
    v = r.where("review_id % 3 = 0").select("review_id", F.when(F.col("review_id") % 2 == 0, "accepted").otherwise("rejected").alias("verdict"), F.lit("r1").alias("reviewer"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    return W.decide(r, v).select("review_id", "status", "reviewed_by")


@query("WITH m AS (SELECT entity_id AS discard, parent_company_entity_id AS keep FROM mdm_company WHERE parent_company_entity_id IS NOT NULL AND parent_company_entity_id <> entity_id) SELECT 'entity' AS what, e.entity_id AS k, CAST(CASE WHEN m.keep IS NOT NULL THEN coalesce(e.valid_to, TIMESTAMP '2024-01-01') ELSE e.valid_to END AS VARCHAR) IS NOT NULL AS hit FROM mdm_company e LEFT JOIN m ON m.discard = e.entity_id UNION ALL SELECT 'reference', coalesce(m.keep, e.entity_id), true FROM mdm_company e LEFT JOIN m ON m.discard = e.entity_id UNION ALL SELECT 'log', keep, true FROM m")
def md_merged(spark, d):
    """Subsidiaries merged into their parents: ended entities, references that moved, and the log."""
    e = table(spark, d, "mdm_company").select("entity_id", "valid_to", F.lit("company").alias("entity_type"))
    m = table(spark, d, "mdm_company").where("parent_company_entity_id IS NOT NULL").select(F.col("parent_company_entity_id").alias("keep"), F.col("entity_id").alias("discard"), F.lit("parent").alias("reason"))
    ended, moved, log = W.merge_entities(e, e.select("entity_id"), m, F.lit("2024-01-01").cast("timestamp"))
    one = lambda df, what, hit=F.lit(True): df.select(F.lit(what).alias("what"), F.col("entity_id").alias("k"), hit.alias("hit"))
    return one(ended, "entity", F.col("valid_to").isNotNull()).unionByName(one(moved, "reference")).unionByName(one(log, "log"))


@query("SELECT s.cik AS record, min(m.entity_id) AS entity_id FROM (SELECT DISTINCT cik FROM sec_company WHERE cik IS NOT NULL) s JOIN mdm_company m ON m.cik = s.cik GROUP BY 1")
def md_resolved(spark, d):
    """Registrants resolved by number before any name is compared."""
    s = table(spark, d, "sec_company").where("cik IS NOT NULL").groupBy("cik").agg(F.max("entity_name").alias("name")).withColumn("record", F.col("cik"))
    r = W.resolve(s, table(spark, d, "mdm_company"), "record", "name", "cik", "entity_id", "canonical_name")
    return r.where("score = 1.0 AND decision = 'auto'").join(table(spark, d, "mdm_company").where("cik IS NOT NULL").select(F.col("cik").alias("record")).distinct(), "record", "left_semi").select("record", "entity_id")


@query("SELECT user_id, event_id, event_type AS decision FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, CASE WHEN event_type = 'purchase' THEN event_id % 2 ELSE 99 END, value DESC, event_id % 2, event_id) AS r FROM events) WHERE r = 1")
def md_first_decision(spark, d):
    """The first automatic match in the order of the matchers, else the best score (events as matches of two matchers)."""
    e = table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("score"), F.when(F.col("event_type") == "purchase", "auto").otherwise(F.col("event_type")).alias("decision"))
    best = mdm.first_decision(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), by="user_id")
    return best.select("user_id", "event_id", F.when(F.col("decision") == "auto", "purchase").otherwise(F.col("decision")).alias("decision"))


_LOG = "SELECT DISTINCT parse_sequence AS id, CAST(cik AS VARCHAR) AS entity_id, CASE WHEN entity_type = 'operating' THEN 'company' WHEN cik % 2 = 0 THEN 'person' ELSE 'other' END AS entity_type, CASE WHEN parse_sequence % 3 = 0 THEN last_synced_at END AS exported_at FROM sec_company WHERE cik IS NOT NULL"


@query(f"WITH l AS ({_LOG}), due AS (SELECT * FROM l WHERE exported_at IS NULL AND entity_type IN ('company', 'person')) SELECT 'company' AS what, count(DISTINCT entity_id) AS n FROM due WHERE entity_type = 'company' UNION ALL SELECT 'person', count(DISTINCT entity_id) FROM due WHERE entity_type = 'person' UNION ALL SELECT 'pending', count(*) FROM l WHERE exported_at IS NULL AND entity_type = 'other'")
def md_exported(spark, d):
    """What an export of pending changes writes per type, and what stays pending."""
    kind = F.when(F.col("entity_type") == "operating", "company").when(F.col("cik") % 2 == 0, "person").otherwise("other")
    log = table(spark, d, "sec_company").where("cik IS NOT NULL").select(F.col("parse_sequence").alias("id"), F.col("cik").cast("string").alias("entity_id"), kind.alias("entity_type"), F.when(F.col("parse_sequence") % 3 == 0, F.col("last_synced_at")).alias("exported_at"), F.col("last_synced_at").alias("changed_at")).select("id", "entity_id", "entity_type", "exported_at", "changed_at").dropDuplicates(["id", "entity_id", "entity_type", "exported_at"])
    all_of = lambda t: log.where(F.col("entity_type") == t).select("entity_id").distinct()
    rows, marked = W.export_pending(log, {"company": all_of("company"), "person": all_of("person")}, F.lit("2024-01-01").cast("timestamp"))
    n = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return n(rows["company"], "company").unionByName(n(rows["person"], "person")).unionByName(n(marked.where("exported_at IS NULL"), "pending"))


# ---------------------------------------------------------------- runs, queues, routing

_REQ = "SELECT event_id AS request_id, ts AS watermark, CASE event_id % 4 WHEN 0 THEN 'requested' WHEN 1 THEN 'graph_pending' WHEN 2 THEN 'published' ELSE 'failed' END AS state, CASE WHEN event_id % 3 = 0 THEN 'w1' END AS claimed_by, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * CASE WHEN event_id % 2 = 0 THEN 5 ELSE -5 END END AS lease FROM events"


def _requests(spark: SparkSession, d: str) -> DataFrame:
    e, k = table(spark, d, "events"), F.col("event_id")
    state = F.when(k % 4 == 0, "requested").when(k % 4 == 1, "graph_pending").when(k % 4 == 2, "published").otherwise("failed")
    lease = F.when(k % 3 == 0, F.when(k % 2 == 0, F.lit("2024-01-01 00:05:00")).otherwise("2023-12-31 23:55:00").cast("timestamp"))
    return e.select(k.alias("request_id"), F.col("ts").cast("timestamp").alias("watermark"), state.alias("state"), F.when(k % 3 == 0, "w1").alias("claimed_by"), lease.alias("lease_expires_at"), F.lit(False).alias("is_backfill"), F.lit(None).cast("timestamp").alias("backfill_deadline"))


@query(f"SELECT request_id, 'w2' AS claimed_by FROM ({_REQ}) WHERE state IN ('requested', 'graph_pending') AND (claimed_by IS NULL OR lease < TIMESTAMP '2024-01-01 00:00:00') ORDER BY watermark, request_id LIMIT 25")
def ot_claims(spark, d):
    return W.claim_oldest(_requests(spark, d), F.lit("2024-01-01").cast("timestamp"), "w2", 60, 25).select("request_id", "claimed_by")


@query(f"WITH p AS (SELECT * FROM ({_REQ}) WHERE state IN ('requested', 'graph_pending')), o AS (SELECT min((watermark, request_id)) AS m FROM p) SELECT 'hard_alert' AS status, struct_extract(m, 2) AS oldest_pending_id, CAST(epoch(TIMESTAMP '2025-01-01') - floor(epoch(struct_extract(m, 1))) AS BIGINT) AS oldest_age_seconds, (SELECT count(*) FROM p) AS n_pending FROM o")
def ot_freshness(spark, d):
    return W.freshness(_requests(spark, d), F.lit("2025-01-01").cast("timestamp"))


@query("SELECT DISTINCT accession_number, CASE WHEN coalesce(bool_or(is_xbrl), false) THEN 'succeeded' WHEN bool_or(form = '8-K') THEN 'repair_required' ELSE 'pending' END AS state FROM filing_activity WHERE accession_number IS NOT NULL GROUP BY 1")
def ot_resume(spark, d):
    f = table(spark, d, "filing_activity").where("accession_number IS NOT NULL")
    o = f.where("is_xbrl").select("accession_number", F.lit("succeeded").alias("status")).unionByName(f.where("form = '8-K'").select("accession_number", F.lit("terminal_repair_required").alias("status"))).unionByName(f.select("accession_number", F.lit("started").alias("status")))
    return W.resumable(f, o, "accession_number")


@query("WITH e AS (SELECT user_id AS run, ts, CASE event_type WHEN 'signup' THEN 'requested' WHEN 'click' THEN 'running' WHEN 'purchase' THEN 'succeeded' WHEN 'error' THEN 'failed' END AS state FROM events), p AS (SELECT *, list_position(['requested', 'running', 'succeeded', 'failed'], state) AS i FROM e WHERE state IS NOT NULL) SELECT run, arg_max(state, i) AS state, min(ts) FILTER (WHERE state = 'running') AS started_at, max(ts) FILTER (WHERE state IN ('succeeded', 'failed')) AS finished_at, count(*) AS n_events FROM p GROUP BY 1")
def ups_run_ledger(spark, d):
    t = F.col("event_type")
    e = table(spark, d, "events").select(F.col("user_id").alias("run"), "ts", F.when(t == "signup", "requested").when(t == "click", "running").when(t == "purchase", "succeeded").when(t == "error", "failed").alias("state"))
    return W.run_ledger(e, "run", "ts")


@query("WITH s AS (SELECT cik % 4 AS shard, cik, last_synced_at FROM sec_company WHERE cik IS NOT NULL), g AS (SELECT shard, count(*) AS n_rows, count(DISTINCT cik) AS n_keys, max(last_synced_at) AS last_at FROM s GROUP BY 1) SELECT *, (SELECT max(n_rows) FROM g) - n_rows AS rows_off, last_at < (SELECT max(last_at) FROM g) AS behind FROM g")
def ups_shard_report(spark, d):
    s = table(spark, d, "sec_company").where("cik IS NOT NULL").withColumn("shard", F.col("cik") % 4)
    return W.shard_report(s, "shard", ["cik"], "last_synced_at")


_BANDS = [(0, 1_010_000), (1_010_001, 1_050_000), (1_050_001, 9_999_999)]
_BAND = lambda c: "CASE " + " ".join(f"WHEN {c} BETWEEN {a} AND {b} THEN {i}" for i, (a, b) in enumerate(_BANDS)) + " END"


@query(f"SELECT 'filing_activity' AS table_name, {_BAND('cik')} AS band, count(*) AS n FROM filing_activity WHERE {_BAND('cik')} IS NOT NULL GROUP BY 2 UNION ALL SELECT 'ownership_activity', {_BAND('f.cik')}, count(*) FROM ownership_activity o JOIN (SELECT accession_number, min(cik) AS cik FROM filing_activity WHERE accession_number IS NOT NULL GROUP BY 1) f USING (accession_number) WHERE {_BAND('f.cik')} IS NOT NULL GROUP BY 2 UNION ALL SELECT 'region', b, (SELECT count(*) FROM region) FROM (SELECT unnest([0, 1, 2]) AS b)")
def ot_bands(spark, d):
    """Tables cut into bands of numbers: by their own, by their filing's, or whole in every band."""
    f, o = table(spark, d, "filing_activity"), table(spark, d, "ownership_activity")
    t = W.route({"filing_activity": (f, "cik")}, {"ownership_activity": (o, f, "accession_number", "cik")}, {"region": table(spark, d, "region")}, _BANDS)
    out = None
    for name, df in t.items():
        one = df.groupBy("band").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "band", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before, CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_before FROM orders")
def ot_lookbacks(spark, d):
    """A month and a year before every day, the day clamped into the month."""
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.add_months(day, -1).alias("month_before"), F.add_months(day, -12).alias("year_before"))


@query("SELECT cik, CASE WHEN arg_max(form, (filing_date, accession_number, fact_key)) = 'D' THEN 'inactive' ELSE 'active' END AS status FROM filing_activity WHERE cik IS NOT NULL AND form IS NOT NULL AND cik IN (SELECT cik FROM sec_company) GROUP BY 1")
def ot_tracked(spark, d):
    """Known registrants with their status: the latest form of one kind (here D) takes a registrant out."""
    f = table(spark, d, "filing_activity").where("cik IS NOT NULL AND form IS NOT NULL").join(table(spark, d, "sec_company").select("cik").distinct(), "cik", "left_semi")
    return f.groupBy("cik").agg(F.when(F.max_by("form", F.struct("filing_date", "accession_number", "fact_key")) == "D", "inactive").otherwise("active").alias("status"))


@query("SELECT cik, accession_number, filing_date FROM (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY filing_date DESC NULLS LAST, fact_key) AS r FROM filing_activity WHERE form IN ('10-K', '10-Q') AND accession_number IS NOT NULL) WHERE r = 1 AND accession_number NOT IN (SELECT accession_number FROM ownership_activity WHERE accession_number IS NOT NULL)")
def ot_candidates(spark, d):
    """One row per filing of the wanted forms that nobody has taken up (here: that has no transactions)."""
    f = table(spark, d, "filing_activity").where("form IN ('10-K', '10-Q') AND accession_number IS NOT NULL")
    best = R.top_per_group(f, ["accession_number"], [F.desc_nulls_last("filing_date"), F.col("fact_key")])
    return best.join(table(spark, d, "ownership_activity").select("accession_number"), "accession_number", "left_anti").select("cik", "accession_number", "filing_date")


@query("SELECT c, string_agg(g, ',' ORDER BY g) AS cohorts FROM (SELECT DISTINCT cik AS c, 'golden' AS g FROM mdm_company WHERE cik IS NOT NULL UNION ALL SELECT DISTINCT cik, 'rest' FROM sec_company WHERE cik IS NOT NULL AND cik NOT IN (SELECT cik FROM mdm_company WHERE cik IS NOT NULL) UNION ALL SELECT DISTINCT cik, 'managers' FROM sec_thirteenf_holding WHERE cik IS NOT NULL AND period_of_report >= DATE '2022-06-30') GROUP BY 1")
def ot_cohorts(spark, d):
    """Lists of registrants: golden ones, the remaining ones, and managers that reported from a quarter on."""
    m = table(spark, d, "mdm_company").where("cik IS NOT NULL").select(F.col("cik").alias("c")).distinct()
    s = table(spark, d, "sec_company").where("cik IS NOT NULL").select(F.col("cik").alias("c")).distinct()
    h = table(spark, d, "sec_thirteenf_holding").where("cik IS NOT NULL AND period_of_report >= date'2022-06-30'").select(F.col("cik").alias("c")).distinct()
    all_of = m.withColumn("g", F.lit("golden")).unionByName(s.join(m, "c", "left_anti").withColumn("g", F.lit("rest"))).unionByName(h.withColumn("g", F.lit("managers")))
    return all_of.groupBy("c").agg(F.array_join(F.array_sort(F.collect_list("g")), ",").alias("cohorts"))


@query("SELECT private_fund_id, adviser_crd_number, fund_name FROM (SELECT *, row_number() OVER (PARTITION BY private_fund_id ORDER BY effective_date DESC NULLS LAST, fund_index DESC NULLS LAST, accession_number DESC, fund_name) AS r FROM sec_adv_private_fund WHERE private_fund_id IS NOT NULL) WHERE r = 1")
def ot_latest_funds(spark, d):
    f = table(spark, d, "sec_adv_private_fund").where("private_fund_id IS NOT NULL")
    return R.top_per_group(f, ["private_fund_id"], [F.desc_nulls_last("effective_date"), F.desc_nulls_last("fund_index"), F.desc("accession_number"), F.col("fund_name")]).select("private_fund_id", "adviser_crd_number", "fund_name")


@query("SELECT CAST(day AS DATE) AS day FROM range(DATE '2022-01-03', DATE '2022-12-31', INTERVAL 1 DAY) t(day) WHERE isodow(day) < 6 AND CAST(day AS DATE) NOT IN (DATE '2022-01-17', DATE '2022-02-21', DATE '2022-05-30', DATE '2022-06-20', DATE '2022-07-04', DATE '2022-09-05', DATE '2022-10-10', DATE '2022-11-11', DATE '2022-11-24', DATE '2022-12-26') AND CAST(day AS DATE) NOT IN (SELECT filing_date FROM filing_activity WHERE form = '10-K' AND filing_date IS NOT NULL)")
def str_missed_days(spark, d):
    """Business days of a year without a filing of a form: what a catch-up would fetch."""
    days = R.date_spine(spark, "2022-01-03", "2022-12-30").where("NOT is_weekend").select("day").join(R.federal_holidays(spark, 2022, 2022).select("day"), "day", "left_anti")
    return days.join(table(spark, d, "filing_activity").where("form = '10-K'").select(F.col("filing_date").alias("day")), "day", "left_anti")


# ---------------------------------------------------------------- dimensions

_KEY = "((('0x' || substr(sha256({}), 1, 16))::UBIGINT) & 9223372036854775807)::BIGINT"
_FAMILY = "CASE WHEN starts_with(form, '10-K') THEN '10-K' WHEN starts_with(form, '10-Q') THEN '10-Q' WHEN starts_with(form, '8-K') THEN '8-K' WHEN form IN ('3', '3/A', '4', '4/A', '5', '5/A') THEN 'ownership' WHEN starts_with(form, 'ADV') THEN 'adv' WHEN starts_with(form, 'DEF 14') OR starts_with(form, 'PRE 14') THEN 'proxy' ELSE 'other' END"


@query(f"SELECT 'form' AS dim, {_KEY.format('form')} AS key, form AS natural_key, {_FAMILY} AS label FROM (SELECT DISTINCT form FROM filing_activity WHERE form IS NOT NULL) UNION ALL SELECT 'filing', {_KEY.format('accession_number')}, accession_number, form FROM (SELECT accession_number, min(form) AS form FROM filing_activity WHERE accession_number IS NOT NULL GROUP BY 1) UNION ALL SELECT 'txn_type', {_KEY.format('c')}, c, c FROM (SELECT DISTINCT nullif(trim(transaction_code), '') AS c FROM ownership_activity) WHERE c IS NOT NULL UNION ALL SELECT 'geography', {_KEY.format('g')}, g, g FROM (SELECT DISTINCT coalesce(state_of_incorporation, '') || '|' || coalesce(state_of_incorporation_desc, '') AS g FROM sec_company) WHERE g <> '|' UNION ALL SELECT 'private_fund', {_KEY.format('private_fund_id')}, private_fund_id, n FROM (SELECT private_fund_id, min(fund_name) AS n FROM sec_adv_private_fund WHERE private_fund_id IS NOT NULL GROUP BY 1) UNION ALL SELECT 'company', {_KEY.format('CAST(cik AS VARCHAR)')}, CAST(cik AS VARCHAR), n FROM (SELECT cik, min(entity_name) AS n FROM sec_company WHERE cik IS NOT NULL GROUP BY 1)")
def dm_dimensions(spark, d):
    """Form, filing, transaction type, geography, fund and company dimensions under one hash key, one row per natural key with the least label."""
    f, o, c, p = (table(spark, d, t) for t in ("filing_activity", "ownership_activity", "sec_company", "sec_adv_private_fund"))
    place = K.geography_key(F.col("state_of_incorporation"), F.col("state_of_incorporation_desc"))
    sides = {"form": (f, F.col("form"), T.form_family(F.col("form"))), "filing": (f, F.col("accession_number"), F.col("form")), "txn_type": (o, K.clean_text(F.col("transaction_code")), K.clean_text(F.col("transaction_code"))), "geography": (c, F.when(place != "|", place), place), "private_fund": (p, F.col("private_fund_id"), F.col("fund_name")), "company": (c, F.col("cik").cast("string"), F.col("entity_name"))}
    out = None
    for name, (df, natural, label) in sides.items():
        one = df.select(natural.alias("natural_key"), label.alias("label")).where("natural_key IS NOT NULL").groupBy("natural_key").agg(F.min("label").alias("label")).select(F.lit(name).alias("dim"), K.hash_key(F.col("natural_key")).alias("key"), "natural_key", "label")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT DISTINCT fact_key, {_KEY.format('accession_number')} AS filing_hash, {_KEY.format('form')} AS form_hash, date_diff('day', report_date, filing_date) AS days_to_file, coalesce(is_xbrl, false) AS is_xbrl FROM filing_activity")
def dm_filing_facts(spark, d):
    f = table(spark, d, "filing_activity")
    return f.select("fact_key", K.hash_key(F.col("accession_number")).alias("filing_hash"), K.hash_key(F.col("form")).alias("form_hash"), F.datediff("filing_date", "report_date").cast("long").alias("days_to_file"), F.coalesce("is_xbrl", F.lit(False)).alias("is_xbrl")).distinct()


@query("SELECT p.accession_number, p.fund_index, lower(nullif(trim(regexp_replace(coalesce(p.fund_name, ''), '\\s+', ' ', 'g')), '')) AS fund_key, p.aum_amount::DOUBLE AS aum, a.adviser_name IS NOT NULL AS has_adviser FROM (SELECT DISTINCT accession_number, fund_index, fund_name, aum_amount FROM sec_adv_private_fund) p LEFT JOIN (SELECT accession_number, max(adviser_name) AS adviser_name FROM sec_adv_filing GROUP BY 1) a ON a.accession_number = p.accession_number")
def dm_fund_facts(spark, d):
    p = table(spark, d, "sec_adv_private_fund").select("accession_number", "fund_index", "fund_name", "aum_amount").distinct()
    a = table(spark, d, "sec_adv_filing").groupBy("accession_number").agg(F.max("adviser_name").alias("adviser_name"))
    return p.join(a, "accession_number", "left").select("accession_number", "fund_index", K.normalized_text(F.col("fund_name")).alias("fund_key"), F.col("aum_amount").cast("double").alias("aum"), F.col("adviser_name").isNotNull().alias("has_adviser"))


@query("SELECT entity_id, CAST((('0x' || substr(md5(entity_id), 1, 8))::UBIGINT) % 16 AS INT) AS shard, regexp_replace(u, '^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$', '\\1-\\2-5\\3-' || ['8', '9', 'a', 'b'][1 + CAST(('0x' || u[17])::UBIGINT % 4 AS INT)] || '\\4-\\5') AS stub_id, cik * 10000 + 1231 AS year_key FROM (SELECT entity_id, cik, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || CAST(entity_id AS BLOB)) AS u FROM mdm_company)".replace("cik * 10000 + 1231", "CAST(2023 * 10000 + 1231 AS INT)"))
def fn_stable_ids(spark, d):
    """Shard numbers from MD5 and version 5 UUIDs from names, the same in every engine."""
    m = table(spark, d, "mdm_company")
    return m.select("entity_id", K.shard_of(F.col("entity_id"), 16).alias("shard"), K.name_uuid("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("entity_id")).alias("stub_id"), K.fiscal_year_key(F.lit(2023)).alias("year_key"))


_PAIRS = [("ownership_activity", "accession_number", "filing_activity", "accession_number"), ("ownership_activity", "company_key", "filing_activity", "company_key"), ("sec_company_former_name", "cik", "sec_company", "cik"), ("sec_adv_private_fund", "accession_number", "sec_adv_filing", "accession_number"), ("mdm_company", "cik", "sec_company", "cik"), ("filing_activity", "cik", "sec_company", "cik"), ("mdm_relationship_instance", "target_entity_id", "mdm_company", "entity_id"), ("review_label", "doc_id", "documents", "doc_id"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")]


@query(" UNION ALL ".join(f"SELECT '{c}.{k}' AS child, '{p}' AS parent, count(*) AS n_rows, count(*) FILTER (WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {q} FROM {p} WHERE {q} IS NOT NULL)) AS n_orphans FROM {c}" for c, k, p, q in _PAIRS))
def dq_references(spark, d):
    """Rows without a parent for every reference of the tables."""
    out = None
    for c, k, p, q in _PAIRS:
        one = R.orphans(table(spark, d, c).select(k), table(spark, d, p), k, q).select(F.lit(f"{c}.{k}").alias("child"), F.lit(p).alias("parent"), "n_rows", "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out
