"""Queries that serve: company surfaces, screens, adviser explorer, readiness, pipeline status, resolvers, dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.operators import finance as fo
from cairnflow.operators import serving as S
from cairnflow.plans import filings, statements
from cairnflow.plans.registry import Query, registrar
from cairnflow.session import table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

_TOP = "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS r FROM ({q})) WHERE r <= {n}"

# ---------------------------------------------------------------- surfaces of a company


@query(_TOP.format(k="cik", o="filing_date DESC NULLS LAST, accession_number DESC NULLS LAST, fact_key", n=5, q="SELECT DISTINCT cik, filing_date, report_date, form, accession_number, is_xbrl, fact_key FROM filing_activity WHERE cik IS NOT NULL"))
def sv_360_filings(spark, d):
    f = table(spark, d, "filing_activity").where("cik IS NOT NULL").select("cik", "filing_date", "report_date", "form", "accession_number", "is_xbrl", "fact_key").distinct()
    return S.surface(f, "cik", [F.desc_nulls_last("filing_date"), F.desc_nulls_last("accession_number"), F.col("fact_key")], 5)


_INSIDE = "SELECT DISTINCT f.cik, f.filing_date, f.form, o.accession_number, o.owner_index, o.txn_index, o.transaction_code, round(o.transaction_shares * o.transaction_price, 4) AS transaction_notional, o.shares_owned_after, o.is_derivative, o.fact_key FROM ownership_activity o LEFT JOIN (SELECT accession_number, max(cik) AS cik, max(filing_date) AS filing_date, max(form) AS form FROM filing_activity GROUP BY 1) f ON f.accession_number = o.accession_number WHERE f.cik IS NOT NULL"


def _inside(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filing_activity").groupBy("accession_number").agg(F.max("cik").alias("cik"), F.max("filing_date").alias("filing_date"), F.max("form").alias("form")).where("cik IS NOT NULL")
    o = table(spark, d, "ownership_activity").join(f, "accession_number")
    return o.select("cik", "filing_date", "form", "accession_number", "owner_index", "txn_index", "transaction_code", F.round(F.col("transaction_shares") * F.col("transaction_price"), 4).alias("transaction_notional"), "shares_owned_after", "is_derivative", "fact_key").distinct()


@query(_TOP.format(k="cik", o="filing_date DESC NULLS LAST, accession_number DESC, owner_index, txn_index, fact_key", n=10, q=_INSIDE))
def sv_360_insiders(spark, d):
    return S.surface(_inside(spark, d), "cik", [F.desc_nulls_last("filing_date"), F.desc("accession_number"), F.col("owner_index"), F.col("txn_index"), F.col("fact_key")], 10)


_NAMED = "SELECT upper(entity_name) AS name, min(cik) AS company_cik FROM (SELECT cik, arg_max(entity_name, parse_sequence) FILTER (WHERE entity_name IS NOT NULL) AS entity_name FROM sec_company WHERE cik IS NOT NULL GROUP BY 1) WHERE entity_name IS NOT NULL GROUP BY 1"


@query(_TOP.format(k="company_cik", o="period_of_report DESC NULLS LAST, market_value DESC NULLS LAST, manager_cik, accession_number, holding_index", n=20, q=f"SELECT DISTINCT c.company_cik, h.cik AS manager_cik, h.period_of_report, h.cusip, h.market_value, h.accession_number, h.holding_index, date_diff('day', h.period_of_report, DATE '2024-01-01') AS lag_days FROM sec_thirteenf_holding h JOIN ({_NAMED}) c ON upper(h.issuer_name) = c.name"))
def sv_360_holders(spark, d):
    """Holders of every company by its present name, with the age of each holding."""
    c = table(spark, d, "sec_company").where("cik IS NOT NULL").groupBy("cik").agg(F.max_by("entity_name", F.when(F.col("entity_name").isNotNull(), F.col("parse_sequence"))).alias("n"))
    c = c.where("n IS NOT NULL").groupBy(F.upper("n").alias("name")).agg(F.min("cik").alias("company_cik"))
    h = table(spark, d, "sec_thirteenf_holding").join(c, F.upper("issuer_name") == F.col("name"))
    h = h.select("company_cik", F.col("cik").alias("manager_cik"), "period_of_report", "cusip", "market_value", "accession_number", "holding_index", F.datediff(F.lit("2024-01-01").cast("date"), "period_of_report").cast("long").alias("lag_days")).distinct()
    return S.surface(h, "company_cik", [F.desc_nulls_last("period_of_report"), F.desc_nulls_last("market_value"), F.col("manager_cik"), F.col("accession_number"), F.col("holding_index")], 20)


_ACT = "generation_id IN (SELECT active_generation_id FROM graph_active_pointer WHERE pointer_id = 'active')"


@query(f"WITH e AS (SELECT DISTINCT edgeid, relationship_type, sourcenodeid, targetnodeid FROM mdm_graph_edges WHERE {_ACT}), n AS (SELECT DISTINCT nodeid, try_cast(json_extract_string(properties, '$.cik') AS BIGINT) AS cik FROM mdm_graph_nodes WHERE {_ACT} AND entity_type = 'company') SELECT DISTINCT n.cik, e.edgeid, e.relationship_type FROM e JOIN n ON (n.nodeid = e.sourcenodeid OR n.nodeid = e.targetnodeid) WHERE n.cik IS NOT NULL")
def sv_360_relationships(spark, d):
    """Edges of the active generation at either end of a company."""
    p = table(spark, d, "graph_active_pointer").where("pointer_id = 'active'").select(F.col("active_generation_id").alias("generation_id"))
    e = table(spark, d, "mdm_graph_edges").join(F.broadcast(p), "generation_id", "left_semi").select("edgeid", "relationship_type", "sourcenodeid", "targetnodeid").distinct()  # one row
    n = table(spark, d, "mdm_graph_nodes").join(F.broadcast(p), "generation_id", "left_semi").where("entity_type = 'company'").select("nodeid", F.get_json_object("properties", "$.cik").try_cast("decimal(38,4)").try_cast("bigint").alias("cik")).where("cik IS NOT NULL").distinct()  # one row
    return S.touching(e, n, "sourcenodeid", "targetnodeid", "nodeid", ["cik"]).select("cik", "edgeid", "relationship_type").distinct()


@query(_TOP.format(k="cik", o="period_end DESC, accession_number DESC", n=4, q=f"SELECT cik, fiscal_year, period_end, accession_number, revenue, round({statements._R('current_assets', 'current_liabilities')}, 8) AS current_ratio, round({statements._R('total_debt', 'assets')}, 8) AS debt_to_assets FROM ({statements._DERIVED})"))
def sv_360_financials(spark, d):
    f = fo.factor_pack(statements.derived(spark, d)).select("cik", "fiscal_year", "period_end", "accession_number", "revenue", F.round("current_ratio", 8).alias("current_ratio"), F.round("debt_to_assets", 8).alias("debt_to_assets"))
    return S.surface(f, "cik", [F.desc("period_end"), F.desc("accession_number")], 4)


@query(f"SELECT cik, auditor, pcaob_id FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY CASE WHEN pcaob_id IS NOT NULL THEN 0 ELSE 1 END, auditor) AS r FROM (SELECT DISTINCT o_custkey AS cik, o_orderpriority AS auditor, CASE WHEN o_orderpriority < '3' THEN o_orderpriority[1] END AS pcaob_id FROM orders)) WHERE r = 1")
def sv_auditor(spark, d):
    """One auditor per company: an identified one first, then by name."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("auditor"), F.when(F.col("o_orderpriority") < "3", F.left("o_orderpriority", F.lit(1))).alias("pcaob_id")).distinct()
    return S.surface(o, "cik", [F.col("pcaob_id").isNull(), F.col("auditor")], 1)


# ---------------------------------------------------------------- screens

_SCREENED = f"SELECT cik, fiscal_year, accession_number, revenue, round({statements._R('current_assets', 'current_liabilities')}, 8) AS current_ratio, round({statements._R('total_debt', 'assets')}, 8) AS debt_to_assets, round({statements._R('free_cash_flow', 'revenue')}, 8) AS fcf_to_revenue FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY period_end DESC, accession_number DESC) AS r FROM ({statements._DERIVED}) WHERE revenue >= 10000 AND {statements._R('current_assets', 'current_liabilities')} >= 1.2 AND {statements._R('total_debt', 'assets')} <= 0.9) JOIN (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_name ILIKE '%supplier%') ON s_suppkey = cik WHERE r = 1"


def fundamentals_screen(factors: DataFrame, companies: DataFrame, key: str, period: str = "FY", min_revenue: float | None = None, min_growth: float | None = None, min_current_ratio: float | None = None, max_debt_to_assets: float | None = None, min_cash_to_assets: float | None = None, max_accruals_to_assets: float | None = None, name: str | None = None, limit: int = 250) -> DataFrame:
    """The latest row within all given bounds of every company that matches ``name``, largest revenue first."""
    least = {"revenue": min_revenue, "revenue_cagr_3y": min_growth, "current_ratio": min_current_ratio, "cash_to_assets": min_cash_to_assets}
    rows = S.screen(factors, least, {"debt_to_assets": max_debt_to_assets, "accruals_to_assets": max_accruals_to_assets}, {"fiscal_period": period})
    rows = S.surface(rows.join(S.screen(companies, like={"name": name}), key), key, [F.desc_nulls_last("period_end"), F.desc("accession_number")], 1)
    return rows.orderBy(F.desc_nulls_last("revenue"), key).limit(S.capped(limit, 250))


@query(_SCREENED.replace("SELECT cik, fiscal_year", "SELECT cik, s_nationkey, fiscal_year", 1) + " ORDER BY revenue DESC NULLS LAST, cik LIMIT 250")
def sv_fundamentals(spark, d):
    c = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cik"), "s_nationkey", F.col("s_name").alias("name"))
    f = fundamentals_screen(fo.factor_pack(statements.derived(spark, d)), c, "cik", min_revenue=10000, min_current_ratio=1.2, max_debt_to_assets=0.9, name="%supplier%")
    return f.select("cik", "s_nationkey", "fiscal_year", "accession_number", "revenue", *(F.round(x, 8).alias(y) for x, y in (("current_ratio", "current_ratio"), ("debt_to_assets", "debt_to_assets"), ("free_cash_flow_to_revenue", "fcf_to_revenue"))))


@query(f"SELECT * FROM ({_INSIDE}) WHERE filing_date BETWEEN DATE '2022-01-01' AND DATE '2023-06-30' AND form ILIKE '4%' AND trim(transaction_code) = 'S' AND transaction_notional >= 100000 AND NOT is_derivative ORDER BY filing_date DESC, accession_number, owner_index, txn_index, fact_key LIMIT 500")
def sv_insider_watch(spark, d):
    """Sales of a size within a period, newest first."""
    i = S.screen(_inside(spark, d).where(F.col("filing_date").between("2022-01-01", "2023-06-30") & (F.trim("transaction_code") == "S")), {"transaction_notional": 100000}, None, {"is_derivative": False}, {"form": "4%"})
    return i.orderBy(F.desc("filing_date"), "accession_number", "owner_index", "txn_index", "fact_key").limit(S.capped(500, 500))


_ADVISER = "SELECT crd_number, arg_max(adviser_name, (effective_date, accession_number)) AS adviser_name, max(accession_number) AS accession_number FROM sec_adv_filing WHERE crd_number IS NOT NULL AND effective_date IS NOT NULL AND adviser_name IS NOT NULL GROUP BY 1"
_FUND = "SELECT private_fund_id, arg_max(fund_name, (effective_date, accession_number, fund_index)) AS fund_name, arg_max(adviser_crd_number, (effective_date, accession_number, fund_index)) AS adviser FROM sec_adv_private_fund WHERE private_fund_id IS NOT NULL AND effective_date IS NOT NULL AND fund_name IS NOT NULL AND adviser_crd_number IS NOT NULL AND fund_index IS NOT NULL GROUP BY 1"


@query(f"SELECT a.crd_number, a.adviser_name, f.private_fund_id, f.fund_name, CASE WHEN a.crd_number IN (SELECT crd_number FROM sec_adv_filing WHERE cik IS NOT NULL) THEN 'available' ELSE 'coverage_unavailable' END AS agent_coverage_state FROM ({_ADVISER}) a LEFT JOIN ({_FUND}) f ON f.adviser = a.crd_number WHERE a.adviser_name ILIKE '%an%' OR f.fund_name ILIKE '%an%' OR a.crd_number ILIKE '%an%' OR f.private_fund_id ILIKE '%an%' ORDER BY a.crd_number, f.private_fund_id LIMIT 5000")
def sv_advisers(spark, d):
    """Advisers with their funds where any of four fields matches, and whether an agent's number is known for them."""
    a0 = table(spark, d, "sec_adv_filing").where("crd_number IS NOT NULL")
    a = a0.where("effective_date IS NOT NULL AND adviser_name IS NOT NULL").groupBy("crd_number").agg(F.max_by("adviser_name", F.struct("effective_date", "accession_number")).alias("adviser_name"))
    f = table(spark, d, "sec_adv_private_fund").where("private_fund_id IS NOT NULL AND effective_date IS NOT NULL AND fund_name IS NOT NULL AND adviser_crd_number IS NOT NULL AND fund_index IS NOT NULL")
    last = F.struct("effective_date", "accession_number", "fund_index")
    f = f.groupBy("private_fund_id").agg(F.max_by("fund_name", last).alias("fund_name"), F.max_by("adviser_crd_number", last).alias("crd_number"))
    known = a0.where("cik IS NOT NULL").select("crd_number").distinct().withColumn("known", F.lit(True))
    j = a.join(f, "crd_number", "left").join(known, "crd_number", "left")
    hit = F.lit(False)
    for c in ("adviser_name", "fund_name", "crd_number", "private_fund_id"):
        hit = hit | F.coalesce(F.col(c).ilike("%an%"), F.lit(False))
    j = j.where(hit).select("crd_number", "adviser_name", "private_fund_id", "fund_name", F.when(F.col("known"), "available").otherwise("coverage_unavailable").alias("agent_coverage_state"))
    return j.orderBy("crd_number", F.asc_nulls_last("private_fund_id")).limit(5000)


# ---------------------------------------------------------------- readiness, status, resolvers


def _status(spark: SparkSession, d: str, state: str) -> DataFrame:
    r = table(spark, d, "graph_review_entity_parity").groupBy("generation_id").agg(F.max("published_at").alias("published_at"), F.count_if(F.col("status") == state).alias("n"))
    p = table(spark, d, "graph_active_pointer")
    newest = r.agg(F.max_by("generation_id", "published_at").alias("active_generation_id")).crossJoin(p.select("activated_at"))  # one row each
    a = S.contract_status(r, p, "generation_id", F.col("n") > 0, [F.desc("published_at")]).withColumn("pointer", F.lit("published"))
    b = S.contract_status(r, newest, "generation_id", F.col("n") > 0, [F.desc("published_at")]).withColumn("pointer", F.lit("newest reviewed"))
    return a.unionByName(b)


@query("WITH r AS (SELECT generation_id, max(published_at) AS published_at, count(*) FILTER (WHERE status = 'fail') AS n FROM graph_review_entity_parity GROUP BY 1), p AS (SELECT 'published' AS pointer, active_generation_id AS g FROM graph_active_pointer UNION ALL SELECT 'newest reviewed', arg_max(generation_id, published_at) FROM r) SELECT p.pointer, CASE WHEN r.n > 0 THEN 'agent_ready' ELSE 'not_ready' END AS readiness_state, CASE WHEN r.n > 0 THEN NULL ELSE 'no_verified_publication' END AS not_ready_reason, p.g AS generation_id, CASE WHEN r.n > 0 THEN r.published_at END AS published_at FROM p LEFT JOIN r ON r.generation_id = p.g")
def sv_contract_status(spark, d):
    """Whether reviews of the active generation, and of the newest reviewed one, were published."""
    return _status(spark, d, "fail").select("pointer", "readiness_state", "not_ready_reason", "generation_id", "published_at")


@query("WITH m AS (SELECT feed_id, max((arrived_at, file_seq)) AS m FROM landing_record GROUP BY 1), s AS (SELECT feed_id, max((arrived_at, file_seq)) AS m FROM landing_record WHERE file_seq % 2 = 0 GROUP BY 1) SELECT coalesce(m.feed_id, s.feed_id) AS feed_id, struct_extract(m.m, 1) AS manifest_arrived_at, struct_extract(m.m, 2) AS manifest_file_seq, struct_extract(s.m, 1) AS status_arrived_at, struct_extract(s.m, 2) AS status_file_seq, CASE WHEN s.m IS NULL THEN 'pending' WHEN struct_extract(s.m, 2) < struct_extract(m.m, 2) THEN 'behind' ELSE 'current' END AS state FROM m FULL JOIN s ON m.feed_id = s.feed_id")
def sv_pipeline_status(spark, d):
    """The newest landing of every feed beside the newest that was taken up (here: every second file)."""
    l = table(spark, d, "landing_record").select("feed_id", "arrived_at", "file_seq")
    j = S.latest_status(l, l.where("file_seq % 2 = 0"), ["feed_id"], "arrived_at")
    return j.withColumn("state", F.when(F.col("status_file_seq").isNull(), "pending").when(F.col("status_file_seq") < F.col("manifest_file_seq"), "behind").otherwise("current"))


@query("SELECT m.entity_id, m.cik, s.entity_name, t.tickers, 'canonical_sec_company_tickers' AS resolution_source FROM mdm_company m JOIN (SELECT cik, string_agg(DISTINCT ticker, ', ' ORDER BY ticker) AS tickers FROM mdm_company WHERE ticker IS NOT NULL AND cik IS NOT NULL GROUP BY 1) t ON t.cik = m.cik LEFT JOIN (SELECT cik, arg_max(entity_name, parse_sequence) FILTER (WHERE entity_name IS NOT NULL) AS entity_name FROM sec_company GROUP BY 1) s ON s.cik = m.cik")
def sv_subject_resolver(spark, d):
    m = table(spark, d, "mdm_company")
    t = m.where("ticker IS NOT NULL AND cik IS NOT NULL").groupBy("cik").agg(F.array_join(F.array_sort(F.collect_set("ticker")), ", ").alias("tickers"))
    s = table(spark, d, "sec_company").groupBy("cik").agg(F.max_by("entity_name", F.when(F.col("entity_name").isNotNull(), F.col("parse_sequence"))).alias("entity_name"))
    return m.select("entity_id", "cik").join(t, "cik").join(s, "cik", "left").select("entity_id", "cik", "entity_name", "tickers", F.lit("canonical_sec_company_tickers").alias("resolution_source"))


@query("WITH f AS (SELECT cik, string_agg(form || ':' || n, ',' ORDER BY form) AS filings, max(last) AS last_filed FROM (SELECT cik, form, count(*) AS n, max(filing_date) AS last FROM filing_activity WHERE cik IS NOT NULL AND form IS NOT NULL GROUP BY 1, 2) GROUP BY 1), r AS (SELECT target_entity_id AS entity_id, string_agg(rel_type_name || ':' || n, ',' ORDER BY rel_type_name) AS relationships FROM (SELECT target_entity_id, rel_type_name, count(DISTINCT source_entity_id) AS n FROM mdm_relationship_instance WHERE is_active AND NOT quarantined GROUP BY 1, 2) GROUP BY 1) SELECT m.entity_id, m.cik, f.filings, f.last_filed, r.relationships, CASE WHEN f.cik IS NULL THEN 'empty' ELSE 'present' END AS filings_state, CASE WHEN r.entity_id IS NULL THEN 'empty' ELSE 'present' END AS relationships_state, 'not_applicable' AS adv_state FROM mdm_company m LEFT JOIN f ON f.cik = m.cik LEFT JOIN r ON r.entity_id = m.entity_id WHERE m.cik IS NOT NULL")
def sv_issuer_bundle(spark, d):
    """Per company its filings by form, relationships by kind, and which sections hold anything; nested arrays written as sorted texts."""
    m = table(spark, d, "mdm_company").where("cik IS NOT NULL").select("entity_id", "cik")
    told = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: F.concat(x["k"], F.lit(":"), x["n"].cast("string"))), ",")
    f = table(spark, d, "filing_activity").where("cik IS NOT NULL AND form IS NOT NULL").groupBy("cik", F.col("form").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("filing_date").alias("last")).groupBy("cik").agg(told(F.collect_list(F.struct("k", "n"))).alias("filings"), F.max("last").alias("last_filed"))
    r = table(spark, d, "mdm_relationship_instance").where("is_active AND NOT quarantined").groupBy(F.col("target_entity_id").alias("entity_id"), F.col("rel_type_name").alias("k")).agg(F.countDistinct("source_entity_id").alias("n")).groupBy("entity_id").agg(told(F.collect_list(F.struct("k", "n"))).alias("relationships"))
    j = m.join(f, "cik", "left").join(r, "entity_id", "left")
    state = lambda c: F.when(F.col(c).isNull(), "empty").otherwise("present")
    return j.select("entity_id", "cik", "filings", "last_filed", "relationships", state("filings").alias("filings_state"), state("relationships").alias("relationships_state"), F.lit("not_applicable").alias("adv_state"))


@query("SELECT * FROM (VALUES ('agent', 'GOLD.COMPANY', true), ('agent', 'raw_payload', false), ('agent', 'company', true), ('explore', 'raw_payload', true), ('agent', '', false)) t(mode, object_name, allowed)")
def flt_mode_policy(spark, d):
    """Which objects either mode may read; a registered query of a forbidden one is refused."""
    r = S.Registry(frozenset({"COMPANY", "FILING_ACTIVITY"}))
    cases = [("agent", "GOLD.COMPANY"), ("agent", "raw_payload"), ("agent", "company"), ("explore", "raw_payload"), ("agent", "")]
    return spark.createDataFrame([(m, o, r.allows(m, o)) for m, o in cases], "mode string, object_name string, allowed boolean")


@query("SELECT entity_id, cik, canonical_name, ein, sic_code, sic_description, state_of_incorporation, fiscal_year_end, ticker, primary_ticker, primary_exchange, tracking_status, parent_company_entity_id, valid_from, valid_to FROM mdm_company WHERE valid_to IS NULL")
def prj_compat_view(spark, d):
    """The fifteen columns of the golden company as a view by name."""
    table(spark, d, "mdm_company").where("valid_to IS NULL").select("entity_id", "cik", "canonical_name", "ein", "sic_code", "sic_description", "state_of_incorporation", "fiscal_year_end", "ticker", "primary_ticker", "primary_exchange", "tracking_status", "parent_company_entity_id", "valid_from", "valid_to").createOrReplaceTempView("compat_mdm_company")
    return spark.table("compat_mdm_company")


# ---------------------------------------------------------------- dashboards


@query("SELECT (SELECT count(DISTINCT cik) FROM sec_company) AS companies, (SELECT count(DISTINCT accession_number) FROM filing_activity) AS filings, (SELECT count(*) FROM mdm_relationship_instance WHERE is_active) AS relationships, (SELECT max(filing_date) FROM filing_activity) AS last_filed")
def sv_overview(spark, d):
    one = lambda t, c, where="true": table(spark, d, t).where(where).agg(c)
    return one("sec_company", F.countDistinct("cik").alias("companies")).crossJoin(one("filing_activity", F.countDistinct("accession_number").alias("filings"))).crossJoin(one("mdm_relationship_instance", F.count(F.lit(1)).alias("relationships"), "is_active")).crossJoin(one("filing_activity", F.max("filing_date").alias("last_filed")))  # one row each


@query(f"SELECT date_trunc('month', filing_date)::DATE AS month, {filings.FAMILY} AS family, count(DISTINCT accession_number) AS filings, count(DISTINCT cik) AS filers FROM filing_activity WHERE filing_date IS NOT NULL GROUP BY 1, 2")
def sv_filings_by_month(spark, d):
    from cairnflow.functions import text as T

    f = table(spark, d, "filing_activity").where("filing_date IS NOT NULL")
    return f.groupBy(F.to_date(F.date_trunc("month", "filing_date")).alias("month"), T.form_family(F.col("form")).alias("family")).agg(F.countDistinct("accession_number").alias("filings"), F.countDistinct("cik").alias("filers"))


@query("SELECT coalesce(security_class, 'unknown') AS security_class, period_of_report, count(*) AS holdings, count(DISTINCT cik) AS managers, sum(CAST(market_value AS DECIMAL(28,2)))::DOUBLE AS market_value FROM sec_thirteenf_holding GROUP BY 1, 2")
def sv_holdings_by_class(spark, d):
    return table(spark, d, "sec_thirteenf_holding").groupBy(F.coalesce("security_class", F.lit("unknown")).alias("security_class"), "period_of_report").agg(F.count(F.lit(1)).alias("holdings"), F.countDistinct("cik").alias("managers"), F.sum(F.col("market_value").cast("decimal(28,2)")).cast("double").alias("market_value"))


@query("SELECT fund_type, coalesce(jurisdiction, 'unknown') AS jurisdiction, count(DISTINCT private_fund_id) AS funds, sum(aum_amount)::DOUBLE AS aum FROM sec_adv_private_fund GROUP BY 1, 2")
def sv_funds_by_type(spark, d):
    return table(spark, d, "sec_adv_private_fund").groupBy("fund_type", F.coalesce("jurisdiction", F.lit("unknown")).alias("jurisdiction")).agg(F.countDistinct("private_fund_id").alias("funds"), F.sum("aum_amount").cast("double").alias("aum"))


@query("SELECT coalesce(nullif(trim(transaction_code), ''), 'none') AS code, date_trunc('quarter', strptime(CAST(date_key AS VARCHAR), '%Y%m%d'))::DATE AS quarter, count(*) AS trades, count(DISTINCT party_key) AS owners, count(*) FILTER (WHERE is_derivative) AS derivative FROM ownership_activity WHERE date_key IS NOT NULL GROUP BY 1, 2")
def sv_trades_by_quarter(spark, d):
    o = table(spark, d, "ownership_activity").where("date_key IS NOT NULL")
    return o.groupBy(F.coalesce(F.nullif(F.trim("transaction_code"), F.lit("")), F.lit("none")).alias("code"), F.to_date(F.date_trunc("quarter", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))).alias("quarter")).agg(F.count(F.lit(1)).alias("trades"), F.countDistinct("party_key").alias("owners"), F.count_if("is_derivative").alias("derivative"))


@query("SELECT rel_type_name, count(*) AS total, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE quarantined) AS quarantined, count(*) FILTER (WHERE valid_to_date IS NULL) AS open, CASE WHEN count(*) FILTER (WHERE is_active) = 0 THEN 'no active rows' WHEN count(*) FILTER (WHERE quarantined) * 20 > count(*) THEN 'much in quarantine' END AS warning FROM mdm_relationship_instance GROUP BY 1")
def ot_mdm_metrics(spark, d):
    """Counts per relationship type with a warning where something is off."""
    g = table(spark, d, "mdm_relationship_instance").groupBy("rel_type_name").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_active").alias("active"), F.count_if("quarantined").alias("quarantined"), F.count_if(F.col("valid_to_date").isNull()).alias("open"))
    return g.withColumn("warning", F.when(F.col("active") == 0, "no active rows").when(F.col("quarantined") * 20 > F.col("total"), "much in quarantine"))


@query("SELECT rel_type_name, instance_id FROM (SELECT DISTINCT rel_type_name, instance_id, updated_at, row_number() OVER (PARTITION BY rel_type_name ORDER BY updated_at DESC, instance_id) AS r FROM (SELECT DISTINCT rel_type_name, instance_id, updated_at FROM mdm_relationship_instance)) WHERE r <= 3")
def ot_mdm_samples(spark, d):
    r = table(spark, d, "mdm_relationship_instance").select("rel_type_name", "instance_id", "updated_at").distinct()
    return r.withColumn("r", F.row_number().over(Window.partitionBy("rel_type_name").orderBy(F.desc("updated_at"), "instance_id"))).where("r <= 3").select("rel_type_name", "instance_id")


_DAY = "DATE '2022-12-31'"


@query(f"SELECT DISTINCT r.target_entity_id AS company, r.source_entity_id AS person, r.rel_type_name FROM mdm_relationship_instance r WHERE r.rel_type_name IN ('INSIDER_AT', 'EMPLOYS') AND r.is_active AND NOT r.quarantined AND (valid_from_date IS NULL OR valid_from_date <= {_DAY}) AND (valid_to_date IS NULL OR valid_to_date > {_DAY})")
def ot_affiliations_as_of(spark, d):
    """Who was affiliated with which company on a day."""
    from cairnflow.operators import relational as R

    r = R.valid_at(table(spark, d, "mdm_relationship_instance").where("rel_type_name IN ('INSIDER_AT', 'EMPLOYS') AND is_active AND NOT quarantined"), F.lit("2022-12-31").cast("date"), "valid_from_date", "valid_to_date")
    return r.select(F.col("target_entity_id").alias("company"), F.col("source_entity_id").alias("person"), "rel_type_name").distinct()
