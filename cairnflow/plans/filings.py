"""Queries of the filing operators: keys, text, merges, statements, holdings, golden records, graphs, serving, checks, streams."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.functions import finance as fin
from cairnflow.functions import keys as K
from cairnflow.functions import text as T
from cairnflow.operators import finance as fo
from cairnflow.operators import graph, mdm, merge, quality
from cairnflow.operators import relational as R
from cairnflow.session import shared_folder, table
from cairnflow.sources import readers, writers
from cairnflow.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _dec(c: str) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


HASH = "((('0x' || substr(sha256({}), 1, 16))::UBIGINT) & 9223372036854775807)::BIGINT"
CLEAN = "nullif(trim(regexp_replace(coalesce({}, ''), '\\s+', ' ', 'g')), '')"

# ---------------------------------------------------------------- scalar functions


@query(f"SELECT DISTINCT fact_key, {HASH.format(chr(39) + 'cik:' + chr(39) + ' || CAST(cik AS VARCHAR)')} AS company_hash, year(filing_date)::INT * 10000 + month(filing_date)::INT * 100 + day(filing_date)::INT AS filed_key FROM filing_activity")
def fn_keys(spark, d):
    return table(spark, d, "filing_activity").select("fact_key", K.hash_key(F.concat(F.lit("cik:"), F.col("cik").cast("string"))).alias("company_hash"), K.date_key(F.col("filing_date")).alias("filed_key")).distinct()


@query(f"SELECT DISTINCT parse_sequence, lower({CLEAN.format('entity_name')}) AS name_key, coalesce('cik:' || CAST(cik AS VARCHAR), 'name:' || lower({CLEAN.format('entity_name')})) AS party, lpad(CAST(cik AS VARCHAR), 10, '0') AS cik_text, coalesce(state_of_incorporation, '') || '|' || coalesce(state_of_incorporation_desc, '') AS place FROM sec_company")
def fn_text_keys(spark, d):
    c = table(spark, d, "sec_company")
    return c.select("parse_sequence", K.normalized_text(F.col("entity_name")).alias("name_key"), K.party_key(F.col("cik"), F.col("entity_name")).alias("party"), K.cik_text(F.col("cik")).alias("cik_text"), K.geography_key(F.col("state_of_incorporation"), F.col("state_of_incorporation_desc")).alias("place")).distinct()


FAMILY = "CASE WHEN starts_with(form, '10-K') THEN '10-K' WHEN starts_with(form, '10-Q') THEN '10-Q' WHEN starts_with(form, '8-K') THEN '8-K' WHEN form IN ('3', '3/A', '4', '4/A', '5', '5/A') THEN 'ownership' WHEN starts_with(form, 'ADV') THEN 'adv' WHEN starts_with(form, 'DEF 14') OR starts_with(form, 'PRE 14') THEN 'proxy' ELSE 'other' END"


@query(f"SELECT DISTINCT form, {FAMILY} AS family FROM filing_activity")
def fn_form_family(spark, d):
    return table(spark, d, "filing_activity").select("form").distinct().select("form", T.form_family(F.col("form")).alias("family"))


@query("""SELECT DISTINCT transaction_code, CASE nullif(trim(transaction_code), '') WHEN 'P' THEN 'purchase' WHEN 'S' THEN 'sale' WHEN 'A' THEN 'award' WHEN 'M' THEN 'exercise' WHEN 'F' THEN 'tax' WHEN 'G' THEN 'gift' ELSE 'other' END AS meaning, nullif(trim(transaction_code), '') AS clean_code FROM ownership_activity""")
def fn_transaction_codes(spark, d):
    clean = K.clean_text(F.col("transaction_code"))
    meaning = F.lit("other")
    for code, label in {"P": "purchase", "S": "sale", "A": "award", "M": "exercise", "F": "tax", "G": "gift"}.items():
        meaning = F.when(clean == code, label).otherwise(meaning)
    return table(spark, d, "ownership_activity").select("transaction_code").distinct().select("transaction_code", meaning.alias("meaning"), clean.alias("clean_code"))


@query("""SELECT DISTINCT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, '{"id":' || event_id || ',"kind":"' || event_type || '","none":null}' AS built FROM events""")
def fn_json(spark, d):
    built = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.lit(None).cast("string").alias("none")), {"ignoreNullFields": "false"})
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), built.alias("built")).distinct()


@query("""SELECT doc_id, len(regexp_extract_all(text, '\\d+(?:\\.\\d+)?\\s*(?:%|percent\\b)')) AS n_percentages, regexp_matches(text, '(?i)\\bemployees\\b') AS mentions_staff, coalesce(max_list, 0) AS staff FROM (SELECT doc_id, text, list_max(list_transform(regexp_extract_all(text, 'number of employees was (\\d+)', 1), lambda x: CAST(x AS INT))) AS max_list FROM documents WHERE text IS NOT NULL)""")
def fn_text_signals(spark, d):
    t = table(spark, d, "documents").where("text IS NOT NULL")
    staff = F.array_max(F.transform(F.regexp_extract_all("text", F.lit(r"number of employees was (\d+)"), F.lit(1)), lambda x: x.cast("int")))
    return t.select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"(\d+(?:\.\d+)?\s*(?:%|percent\b))"), F.lit(1))).cast("long").alias("n_percentages"), F.col("text").rlike(r"(?i)\bemployees\b").alias("mentions_staff"), F.coalesce(staff, F.lit(0)).alias("staff"))


@query("""WITH p AS (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS v, p_partkey % 5 AS m FROM part) SELECT p_partkey, CASE m WHEN 0 THEN round(v * 1e9, 0) WHEN 1 THEN round(v * 1e6, 0) WHEN 2 THEN round(v * 1e3, 0) WHEN 3 THEN CAST(v AS DOUBLE) END AS value FROM p""")
def fn_scaled_number(spark, d):
    """Prices written out with their scale and read back; a text without a number gives NULL."""
    v = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    m = F.col("p_partkey") % 5
    text = F.when(m == 0, F.concat(F.lit("USD "), v, F.lit(" billion"))).when(m == 1, F.concat(v, F.lit(" million"))).when(m == 2, F.concat(v, F.lit(" thousand"))).when(m == 3, v).otherwise("none")
    p = table(spark, d, "part").select("p_partkey", m.alias("m"), T.scaled_number(text).alias("v"))
    return p.select("p_partkey", F.when(F.col("m") < 3, F.round("v", 0)).otherwise(F.col("v")).alias("value"))


@query("""WITH p AS (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS v, CAST(p_size AS DOUBLE) AS s, p_partkey % 9 AS m FROM part),
r AS (SELECT p_partkey, m, CASE WHEN m = 8 THEN NULL WHEN m IN (4, 7) THEN -v ELSE v END AS v, s FROM p) SELECT p_partkey, CASE WHEN m IN (0, 1) THEN least(s, v) ELSE v END AS low, CASE WHEN m IN (0, 1) THEN (s + v) / 2 ELSE v END AS mid, CASE WHEN m IN (0, 1) THEN greatest(s, v) ELSE v END AS high FROM r""")
def fn_guided_range(spark, d):
    """Prices and sizes written as guidance cells and read back: ranges, points, negatives, brackets that are none, text around, dashes without blanks."""
    v, s = F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.col("p_size").cast("string")
    forms = [F.concat(F.lit("$"), s, F.lit(" - $"), v), F.concat(s, F.lit(" to "), v), F.concat(F.lit("about $ "), v, F.lit(" a share")), F.concat(v, F.lit("-"), s), F.concat(F.lit("-"), v), F.concat(F.lit("("), v, F.lit(")")), F.concat(v, F.lit("%")), F.concat(F.lit("($"), v, F.lit(")")), F.lit("N/A")]
    text = F.get(F.array(*forms), (F.col("p_partkey") % 9).cast("int"))
    return table(spark, d, "part").select("p_partkey", T.guided_range(text).alias("r")).select("p_partkey", "r.low", "r.mid", "r.high")


@query("""SELECT DISTINCT accession_number, holding_index, CASE WHEN cusip IS NULL THEN 'coverage_unavailable' WHEN period_of_report < DATE '2022-01-01' THEN 'insufficient_history' WHEN shares_held IS NULL THEN 'value_unavailable' WHEN shares_held = 0 THEN 'numeric_zero' ELSE 'available' END AS state FROM (SELECT accession_number, holding_index, cusip, period_of_report, CASE WHEN holding_index % 7 = 0 THEN 0 ELSE shares_held END AS shares_held FROM sec_thirteenf_holding)""")
def fn_data_state(spark, d):
    h = table(spark, d, "sec_thirteenf_holding").withColumn("s", F.when(F.col("holding_index") % 7 == 0, F.lit(0.0)).otherwise(F.col("shares_held")))
    return h.select("accession_number", "holding_index", T.data_state(F.col("s"), ~F.coalesce(F.col("period_of_report") < F.lit("2022-01-01").cast("date"), F.lit(False)), F.col("cusip").isNotNull()).alias("state")).distinct()


@query("""SELECT DISTINCT security_title, CASE WHEN regexp_matches(security_title, '(?i)\\b(note|notes|bond|bonds|deb|debenture|sr\\.?\\s+note|senior\\s+note)\\b') THEN 'fixed_income' WHEN regexp_matches(security_title, '(?i)\\b(etf|fund|trust|tr\\s+unit|trust\\s+unit|index\\s+fund|spdr|ishare)\\b') THEN 'etf_fund' WHEN regexp_matches(security_title, '(?i)\\b(wt|warr|warrant|warrants)\\b') THEN 'warrant' ELSE 'unknown_security' END AS class,
'equity' AS with_ticker FROM sec_thirteenf_holding""")
def fn_security_class(spark, d):
    return table(spark, d, "sec_thirteenf_holding").select("security_title").distinct().select("security_title", T.security_class(F.col("security_title")).alias("class"), T.security_class(F.col("security_title"), F.lit("ABC")).alias("with_ticker"))


@query("""WITH l(label, metric, adjusted, unit) AS (VALUES ('Diluted EPS', 'eps_diluted', false, 'per_share'), ('Adjusted EBITDA', 'ebitda', true, 'USD'), ('EPS - basic', 'eps_basic', false, 'per_share'), ('Non-GAAP operating margin', 'operating_margin', true, 'percent'), ('Net sales', 'revenue', false, 'USD'), ('Capital expenditures', 'capex', false, 'USD'), ('As adjusted FCF', 'free_cash_flow', true, 'USD'), ('EBIT before EBITDA', 'ebitda', false, 'USD'), ('Store openings', 'other', false, 'USD'), ('', 'other', false, 'USD'), (NULL, 'other', false, 'USD'))
SELECT p_partkey, l.* FROM part JOIN (SELECT *, row_number() OVER () - 1 AS i FROM l) l ON p_partkey % 11 = i""".replace("l.* FROM", "label, metric, adjusted, unit FROM"))
def fn_guided_metric(spark, d):
    labels = ["Diluted EPS", "Adjusted EBITDA", "EPS - basic", "Non-GAAP operating margin", "Net sales", "Capital expenditures", "As adjusted FCF", "EBIT before EBITDA", "Store openings", "", None]
    label = F.get(F.array(*(F.lit(x) for x in labels)), (F.col("p_partkey") % 11).cast("int"))
    return table(spark, d, "part").select("p_partkey", label.alias("label"), T.guided_metric(label).alias("m")).select("p_partkey", "label", "m.metric", F.col("m.is_non_gaap").alias("adjusted"), "m.unit")


@query("SELECT CAST(day AS DATE) AS day, year(day) * 10000 + month(day) * 100 + day(day) AS date_key, year(day) AS year, quarter(day) AS quarter, month(day) AS month, day(day) AS day_of_month, isodow(day) - 1 AS day_of_week, isodow(day) >= 6 AS is_weekend FROM range(DATE '2023-01-01', DATE '2024-01-01', INTERVAL 1 DAY) t(day)")
def fn_date_spine(spark, d):
    s = R.date_spine(spark, "2023-01-01", "2023-12-31")
    return s.select("day", *(F.col(c).cast("long").alias(c) for c in ("date_key", "year", "quarter", "month", "day_of_month", "day_of_week")), "is_weekend")


@query("""WITH h(day) AS (VALUES (DATE '2023-01-02'), (DATE '2023-01-16'), (DATE '2023-02-20'), (DATE '2023-05-29'), (DATE '2023-06-19'), (DATE '2023-07-04'), (DATE '2023-09-04'), (DATE '2023-10-09'), (DATE '2023-11-10'), (DATE '2023-11-23'), (DATE '2023-12-25'), (DATE '2024-01-01')), s AS (SELECT CAST(day AS DATE) AS day FROM range(DATE '2023-01-01', DATE '2023-12-30', INTERVAL 1 DAY) t(day)),
b AS (SELECT CAST(day AS DATE) AS b FROM range(DATE '2023-01-01', DATE '2024-01-15', INTERVAL 1 DAY) t(day) WHERE isodow(day) < 6 AND CAST(day AS DATE) NOT IN (SELECT day FROM h)) SELECT s.day, min(b) AS next_day FROM s JOIN b ON b > s.day GROUP BY 1""")
def fn_business_days(spark, d):
    days = R.date_spine(spark, "2023-01-01", "2023-12-29").select("day")
    return R.next_business_day(days, "day", R.federal_holidays(spark, 2023, 2024))


# ---------------------------------------------------------------- merges


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value, arg_max(props, event_id) AS props, arg_min(ts, event_id) AS ts FROM events GROUP BY 1, 2")
def ups_split_first_last(spark, d):
    e = table(spark, d, "events")
    return merge.collapse(e, merge.MergeSpec(("user_id", "event_type"), first=("ts",)), "event_id")


@query("SELECT cik, max(parse_sequence) AS parse_sequence, " + ", ".join(f"arg_max({c}, parse_sequence) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("ein", "sic", "category")) + " FROM sec_company GROUP BY 1")
def ups_coalesce(spark, d):
    c = table(spark, d, "sec_company").select("cik", "parse_sequence", "ein", "sic", "category")
    return merge.collapse(c, merge.MergeSpec(("cik",), coalesce=("*",)), "parse_sequence")


@query("SELECT cik, max(parse_sequence) AS parse_sequence, arg_max_null(ein, parse_sequence) AS ein, arg_max_null(category, parse_sequence) AS category FROM (SELECT DISTINCT cik, parse_sequence, ein, category FROM sec_company) GROUP BY 1")
def ups_last_wins(spark, d):
    c = table(spark, d, "sec_company").select("cik", "parse_sequence", "ein", "category")
    return merge.collapse(c, merge.MergeSpec(("cik",)), "parse_sequence")


def _whole(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All customers as a target, and a batch of the even keys changed and of the odd ones under new, negative keys."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    key = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("c_custkey")
    return c, c.select(key, "c_mktsegment", (F.col("c_acctbal") + 1).alias("c_acctbal"))


@query("SELECT c_custkey, c_mktsegment, c_acctbal + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS c_acctbal FROM customer UNION ALL SELECT -c_custkey, c_mktsegment, c_acctbal + 1 FROM customer WHERE c_custkey % 2 = 1")
def ups_merge(spark, d):
    return merge.merge_matched(*_whole(spark, d), ["c_custkey"])


@query("SELECT c_custkey, c_mktsegment, c_acctbal + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS c_acctbal FROM customer UNION ALL SELECT -c_custkey, c_mktsegment, c_acctbal + 1 FROM customer WHERE c_custkey % 2 = 1")
def ups_upsert(spark, d):
    return merge.upsert(*_whole(spark, d), ["c_custkey"])


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer UNION ALL SELECT -c_custkey, c_mktsegment, c_acctbal + 1 FROM customer WHERE c_custkey % 2 = 1")
def ups_seed(spark, d):
    return merge.upsert(*_whole(spark, d), ["c_custkey"], insert_only=True)


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey, c_mktsegment, 0.0 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0")
def ups_replace_scope(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return merge.replace_scope(c, c.where("c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0)), ["c_mktsegment"])


@query("""WITH l AS (SELECT cik, arg_max_null(category, parse_sequence) AS category, max(last_synced_at) AS last_synced_at FROM (SELECT DISTINCT cik, parse_sequence, category, last_synced_at FROM sec_company WHERE parse_sequence % 2 = 0) GROUP BY 1), r AS (SELECT cik, arg_max_null(category, parse_sequence) AS category, max(last_synced_at) AS last_synced_at FROM (SELECT DISTINCT cik, parse_sequence, category, last_synced_at FROM sec_company WHERE parse_sequence % 2 = 1) GROUP BY 1),
j AS (SELECT coalesce(l.cik, r.cik) AS cik, l.category AS lc, r.category AS rc, l.last_synced_at AS lt, r.last_synced_at AS rt, CASE WHEN l.cik IS NULL THEN 'new' WHEN r.cik IS NULL THEN 'kept' WHEN l.category IS NOT DISTINCT FROM r.category THEN 'same' WHEN r.last_synced_at > l.last_synced_at THEN 'candidate' WHEN l.last_synced_at > r.last_synced_at THEN 'kept' ELSE 'conflict' END AS outcome FROM l FULL JOIN r ON l.cik = r.cik)
SELECT cik, CASE WHEN outcome IN ('new', 'candidate') THEN rc ELSE lc END AS category, CASE WHEN outcome IN ('new', 'candidate') THEN rt ELSE lt END AS last_synced_at, outcome FROM j""")
def ups_authority(spark, d):
    c = table(spark, d, "sec_company").select("cik", "parse_sequence", "category", "last_synced_at")
    half = lambda r: c.where(F.col("parse_sequence") % 2 == r).groupBy("cik").agg(F.max(F.struct("parse_sequence", "category")).alias("m"), F.max("last_synced_at").alias("last_synced_at")).select("cik", F.col("m.category").alias("category"), "last_synced_at")
    return merge.authority_merge(half(0), half(1), merge.SPECS["sec_company"])


@query("SELECT fact_key, CASE WHEN cik IS NULL THEN 'no cik' || CASE WHEN form IS NULL THEN ',no form' ELSE '' END ELSE 'no form' END AS reasons FROM (SELECT DISTINCT fact_key, cik, form FROM filing_activity) WHERE cik IS NULL OR form IS NULL")
def ups_rejects(spark, d):
    f = table(spark, d, "filing_activity").select("fact_key", "cik", "form").distinct()
    _, bad = merge.split_rejects(f, {"no cik": F.col("cik").isNull(), "no form": F.col("form").isNull()})
    return bad.select("fact_key", F.array_join("reasons", ",").alias("reasons"))


# ---------------------------------------------------------------- statements

_STATE = """SELECT l_suppkey AS k, year(l_shipdate)::INT AS y, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS revenue, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS assets, sum(CAST(l_discount * 1000 AS DECIMAL(18,2)))::DOUBLE AS liabilities, sum(CAST(l_tax * 1000 AS DECIMAL(18,2)))::DOUBLE AS net_income FROM lineitem GROUP BY 1, 2"""


def statements(spark: SparkSession, d: str) -> DataFrame:
    """Yearly statements of suppliers, made of line items."""
    l = table(spark, d, "lineitem").withColumns({"a": F.col("l_discount") * 1000, "b": F.col("l_tax") * 1000})
    return l.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("y")).agg(_dec("l_extendedprice").alias("revenue"), _dec("l_quantity").alias("assets"), _dec("a").alias("liabilities"), _dec("b").alias("net_income"))


@query(f"""WITH b AS ({_STATE}) SELECT b.k, b.y, b.revenue, b.assets, round(CASE WHEN p.revenue <> 0 THEN (b.revenue - p.revenue) / p.revenue END, 9) AS revenue_growth, round(CASE WHEN q.revenue > 0 AND b.revenue > 0 THEN pow(b.revenue / q.revenue, 1.0 / 3) - 1 END, 9) AS revenue_cagr_3, round(CASE WHEN r.revenue > 0 AND b.revenue > 0 THEN pow(b.revenue / r.revenue, 1.0 / 5) - 1 END, 9) AS revenue_cagr_5
FROM b LEFT JOIN b p ON p.k = b.k AND p.y = b.y - 1 LEFT JOIN b q ON q.k = b.k AND q.y = b.y - 3 LEFT JOIN b r ON r.k = b.k AND r.y = b.y - 5""")
def dm_growth_pack(spark, d):
    b = statements(spark, d).select("k", "y", "revenue", "assets")
    g = fo.growth_pack(b, "k", "y", ["revenue"])
    return g.select("k", "y", "revenue", "assets", *(F.round(c, 9).alias(c) for c in ("revenue_growth", "revenue_cagr_3", "revenue_cagr_5")))


@query(f"""WITH b AS ({_STATE}) SELECT k, y, round(CASE WHEN assets <> 0 THEN net_income / assets END, 9) AS roa, round(CASE WHEN liabilities > 0 THEN net_income / liabilities END, 9) AS roe, round(CASE WHEN revenue <> 0 THEN net_income / revenue END, 9) AS margin FROM b""")
def dm_ratios(spark, d):
    b = statements(spark, d)
    c = F.col
    return b.select("k", "y", F.round(fin.safe_ratio(c("net_income"), c("assets")), 9).alias("roa"), F.round(fin.safe_ratio_signed(c("net_income"), c("liabilities")), 9).alias("roe"), F.round(fin.safe_ratio(c("net_income"), c("revenue")), 9).alias("margin"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE round(-1.5 - l_tax * 12, 2) END AS m, CASE WHEN l_linenumber = 7 THEN NULL ELSE round(1 + l_discount * 25, 2) END AS z, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) % 10 END AS f FROM lineitem)
SELECT DISTINCT m, z, f, CASE WHEN m > -1.78 THEN 'high' WHEN m BETWEEN -2.22 AND -1.78 THEN 'medium' WHEN m < -2.22 THEN 'low' ELSE 'unknown' END AS mt, CASE WHEN z > 2.99 THEN 'safe' WHEN z BETWEEN 1.81 AND 2.99 THEN 'grey' WHEN z < 1.81 THEN 'distress' ELSE 'unknown' END AS zt, CASE WHEN f >= 7 THEN 'strong' WHEN f BETWEEN 3 AND 6 THEN 'neutral' WHEN f <= 2 THEN 'weak' ELSE 'unknown' END AS ft FROM x""")
def dm_tiers(spark, d):
    known = F.col("l_linenumber") != 7
    x = table(spark, d, "lineitem").select(F.when(known, F.round(-1.5 - F.col("l_tax") * 12, 2)).alias("m"), F.when(known, F.round(1 + F.col("l_discount") * 25, 2)).alias("z"), F.when(known, F.col("l_quantity").cast("int") % 10).alias("f")).distinct()
    return x.select("m", "z", "f", fin.manipulation_tier(F.col("m")).alias("mt"), fin.distress_tier(F.col("z")).alias("zt"), fin.strength_tier(F.col("f")).alias("ft"))


@query("""SELECT user_id, event_id, coalesce(event_type <> lag(event_type) OVER w, false) AS changed, CAST(sum(CASE WHEN coalesce(event_type <> lg, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS unchanged_so_far FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS lg FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def dm_tenure(spark, d):
    return fo.tenure(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type").select("user_id", "event_id", "changed", "unchanged_so_far")


@query("SELECT cik, parse_sequence, row_number() OVER (PARTITION BY cik ORDER BY last_synced_at DESC NULLS LAST, parse_sequence DESC) = 1 AS is_current FROM (SELECT DISTINCT cik, parse_sequence, last_synced_at FROM sec_company)")
def dm_revisions(spark, d):
    c = table(spark, d, "sec_company").select("cik", "parse_sequence", "last_synced_at").distinct()
    return fo.revisions(c, ["cik"], "last_synced_at", [F.desc("parse_sequence")]).select("cik", "parse_sequence", "is_current")


@query("""WITH o AS (SELECT o_custkey AS k, strftime(o_orderdate, '%Y-%m') AS p, o_orderdate AS f, o_orderkey AS a, CASE WHEN o_orderpriority LIKE '1%' THEN 'restatement' WHEN o_orderpriority LIKE '5%' THEN 'addition' ELSE 'base' END AS kind FROM orders), b AS (SELECT *, max(CASE WHEN kind <> 'addition' THEN (f, a) END) OVER (PARTITION BY k, p) AS base FROM o) SELECT k, p, a, kind FROM b WHERE base IS NULL OR (f, a) >= base""")
def dm_effective_filings(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("p"), F.col("o_orderdate").alias("f"), F.col("o_orderkey").alias("a"), F.when(F.col("o_orderpriority").startswith("1"), "restatement").when(F.col("o_orderpriority").startswith("5"), "addition").otherwise("base").alias("kind"))
    return fo.effective_filings(o, ["k", "p"], "kind", "f", "a").select("k", "p", "a", "kind")


_HELD = """SELECT cik, cusip, period_of_report, sum(CAST(shares_held AS DECIMAL(28,4)))::DOUBLE AS shares, sum(CAST(market_value AS DECIMAL(28,4)))::DOUBLE AS value FROM (SELECT DISTINCT cik, accession_number, holding_index, cusip, period_of_report, shares_held, market_value FROM sec_thirteenf_holding WHERE cusip IS NOT NULL AND cik IS NOT NULL) GROUP BY 1, 2, 3"""


def _held(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "sec_thirteenf_holding").where("cusip IS NOT NULL AND cik IS NOT NULL").select("cik", "accession_number", "holding_index", "cusip", "period_of_report", "shares_held", "market_value").distinct()
    return h.groupBy("cik", "cusip", "period_of_report").agg(F.sum(F.col("shares_held").cast("decimal(28,4)")).cast("double").alias("shares"), F.sum(F.col("market_value").cast("decimal(28,4)")).cast("double").alias("value"))


@query(f"""WITH h AS ({_HELD}), l AS (SELECT *, lag(shares) OVER w AS was FROM h WINDOW w AS (PARTITION BY cik, cusip ORDER BY period_of_report))
SELECT cik, cusip, period_of_report, shares - was AS change, CASE WHEN was <> 0 THEN (shares - was) / was END AS change_pct, rank() OVER (PARTITION BY cusip, period_of_report ORDER BY coalesce(value, 0) DESC) AS holder_rank, row_number() OVER (PARTITION BY cik, cusip ORDER BY period_of_report DESC) = 1 AS is_latest FROM l""")
def dm_holding_changes(spark, d):
    return fo.period_changes(_held(spark, d), ["cik"], "cusip", "period_of_report", "shares", "value").select("cik", "cusip", "period_of_report", "change", "change_pct", "holder_rank", "is_latest")


@query("""WITH l AS (SELECT * FROM (SELECT DISTINCT crd_number, accession_number, effective_date, filing_action, row_number() OVER (PARTITION BY crd_number ORDER BY effective_date DESC NULLS LAST, accession_number DESC) AS r FROM (SELECT DISTINCT crd_number, accession_number, effective_date, filing_action FROM sec_adv_filing)) WHERE r = 1)
SELECT DISTINCT f.adviser_crd_number AS crd, f.private_fund_id FROM sec_adv_private_fund f JOIN l ON f.accession_number = l.accession_number WHERE f.private_fund_id IS NOT NULL AND coalesce(lower(l.filing_action), '') NOT LIKE '%terminat%' AND coalesce(lower(l.filing_action), '') NOT LIKE '%withdraw%'""")
def dm_effective_advisers(spark, d):
    f = table(spark, d, "sec_adv_filing").select("crd_number", "accession_number", "effective_date", "filing_action").distinct()
    last = R.top_per_group(f, ["crd_number"], [F.desc_nulls_last("effective_date"), F.desc("accession_number")])
    live = last.where(~F.lower(F.coalesce("filing_action", F.lit(""))).rlike("terminat|withdraw")).select("accession_number")
    return table(spark, d, "sec_adv_private_fund").join(live, "accession_number", "left_semi").where("private_fund_id IS NOT NULL").select(F.col("adviser_crd_number").alias("crd"), "private_fund_id").distinct()


@query("""WITH t AS (SELECT DISTINCT fact_key, party_key, security_key, date_key, owner_index, txn_index, shares_owned_after FROM ownership_activity WHERE party_key IS NOT NULL AND security_key IS NOT NULL) SELECT party_key, security_key, shares_owned_after FROM (SELECT *, row_number() OVER (PARTITION BY party_key, security_key ORDER BY date_key DESC NULLS LAST, fact_key DESC) AS r FROM t) WHERE r = 1""")
def dm_holding_snapshot(spark, d):
    t = table(spark, d, "ownership_activity").where("party_key IS NOT NULL AND security_key IS NOT NULL").select("fact_key", "party_key", "security_key", "date_key", "owner_index", "txn_index", "shares_owned_after").distinct()
    return R.top_per_group(t, ["party_key", "security_key"], [F.desc_nulls_last("date_key"), F.desc("fact_key")]).select("party_key", "security_key", "shares_owned_after")


_WACC_INPUT = "SELECT o_orderkey, o_totalprice * (o_orderkey % 11 - 1) AS cap, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 4) * 50000.0 END AS debt, CASE WHEN o_orderkey % 3 > 0 THEN 0.5 + (o_orderkey % 7) / 5.0 END AS beta, CASE WHEN o_orderkey % 7 > 0 THEN -1000.0 * (o_orderkey % 9) END AS interest, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * (o_orderkey % 6) / 10 END AS tax, o_totalprice * (o_orderkey % 5 - 1) AS pretax FROM orders"


@query(f"""WITH x AS ({_WACC_INPUT}), y AS (SELECT *, coalesce(debt, 0) AS d, CASE WHEN debt > 0 THEN abs(interest) / debt END AS kd, tax IS NOT NULL AND pretax > 0 AS known FROM x) SELECT o_orderkey, CASE WHEN cap > 0 THEN round(cap / (cap + d) * (0.04 + coalesce(beta, 1.0) * 0.057) + coalesce(d / (cap + d) * kd * (1 - CASE WHEN known THEN least(tax / pretax, 0.40) ELSE 0.21 END), 0), 6) END AS wacc,
CASE WHEN cap > 0 THEN concat_ws(',', CASE WHEN beta IS NULL THEN 'beta' END, 'risk_free_rate', CASE WHEN NOT coalesce(known, false) AND debt > 0 THEN 'tax_rate' END) ELSE 'market_cap' END AS assumed FROM y""")
def dm_wacc(spark, d):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    x = table(spark, d, "orders").select("o_orderkey", (price * (k % 11 - 1)).alias("cap"), F.when(k % 5 != 0, (k % 4) * 50000.0).alias("debt"), F.when(k % 3 > 0, 0.5 + (k % 7) / 5.0).alias("beta"), F.when(k % 7 > 0, -1000.0 * (k % 9)).alias("interest"), F.when(k % 2 == 0, price * (k % 6) / 10).alias("tax"), (price * (k % 5 - 1)).alias("pretax"))
    w = x.withColumn("w", fin.cost_of_capital(*(F.col(c) for c in ("cap", "debt", "beta", "interest", "tax", "pretax"))))
    return w.select("o_orderkey", "w.wacc", F.array_join("w.assumed", ",").alias("assumed"))


@query("SELECT o_orderkey, CASE WHEN cap > 0 THEN cap + coalesce(debt, 0) - coalesce(interest, 0) END AS ev FROM (" + _WACC_INPUT + ")")
def dm_enterprise_value(spark, d):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", fin.enterprise_value(price * (k % 11 - 1), F.when(k % 5 != 0, (k % 4) * 50000.0), F.when(k % 7 > 0, -1000.0 * (k % 9))).alias("ev"))


@query("""SELECT cik, upper(trim(ticker)) AS ticker FROM (SELECT cik, ticker, row_number() OVER (PARTITION BY cik ORDER BY CASE WHEN upper(trim(primary_exchange)) = 'NYSE' THEN 0 WHEN upper(trim(primary_exchange)) IN ('NASDAQ', 'NYSE', 'NYSE ARCA', 'NYSE MKT', 'AMEX', 'BATS') THEN 1 ELSE 2 END, ticker, entity_id) AS r FROM mdm_company WHERE cik IS NOT NULL AND trim(ticker) <> '') WHERE r = 1""")
def dm_primary_ticker(spark, d):
    return fo.primary_tickers(table(spark, d, "mdm_company"), "cik", "ticker", "primary_exchange", [F.col("ticker"), F.col("entity_id")], "nyse")


@query("""SELECT m.entity_id, s.cik, s.n AS n_syncs, count(*) OVER (PARTITION BY m.cik) > 1 AS several FROM mdm_company m LEFT JOIN (SELECT cik, count(*) AS n FROM sec_company GROUP BY 1) s ON m.cik = s.cik""")
def dm_company_enriched(spark, d):
    s = table(spark, d, "sec_company").groupBy("cik").agg(F.count(F.lit(1)).alias("n_syncs")).select(F.col("cik").alias("scik"), "n_syncs")
    m = table(spark, d, "mdm_company").select("entity_id", "cik")
    return m.join(s, m["cik"] == s["scik"], "left").select("entity_id", F.col("scik").alias("cik"), "n_syncs", (F.count(F.lit(1)).over(Window.partitionBy(m["cik"])) > 1).alias("several"))


@query("""SELECT security_key, min(accession_number) AS first_accession, count(DISTINCT company_key) AS companies FROM ownership_activity WHERE security_key IS NOT NULL GROUP BY 1""")
def dm_security_dim(spark, d):
    return table(spark, d, "ownership_activity").where("security_key IS NOT NULL").groupBy("security_key").agg(F.min("accession_number").alias("first_accession"), F.countDistinct("company_key").alias("companies"))


# ---------------------------------------------------------------- golden records


@query("SELECT m.entity_id, s.cik AS scik, 1.0 AS score, 'auto' AS decision FROM mdm_company m JOIN (SELECT DISTINCT cik FROM sec_company) s ON m.cik = s.cik")
def md_exact(spark, d):
    s = table(spark, d, "sec_company").select("cik").distinct().withColumn("scik", F.col("cik"))
    return mdm.exact_matches(table(spark, d, "mdm_company").select("entity_id", "cik"), s, "entity_id", "scik", "cik")


_BARE = "nullif(array_to_string(list_transform(list_filter(string_split_regex(lower(regexp_replace({}, '[^\\w\\s]', ' ', 'g')), '\\s+'), lambda x: x <> '' AND NOT list_contains(['inc','incorporated','llc','corp','corporation','lp','ltd','limited','plc','trust','fund','group','partners','associates','co','na','holdings','services'], x)), lambda x: upper(x[1]) || x[2:]), ' '), '')"


@query(f"""WITH a AS (SELECT DISTINCT entity_id, state_of_incorporation AS s, {_BARE.format("canonical_name")} AS n FROM mdm_company WHERE canonical_name IS NOT NULL), b AS (SELECT DISTINCT crd_number, {_BARE.format("adviser_name")} AS n FROM sec_adv_filing WHERE adviser_name IS NOT NULL AND crd_number IS NOT NULL),
s AS (SELECT entity_id, crd_number, jaro_winkler_similarity(a.n, b.n) AS score FROM a JOIN b ON a.n IS NOT NULL AND b.n IS NOT NULL), t AS (SELECT * FROM s WHERE score >= 0.95) SELECT entity_id, arg_min(crd_number, (-score, crd_number)) AS crd_number, round(max(score), 9) AS score FROM t GROUP BY 1""")
def md_fuzzy(spark, d):
    """Entities whose name matches an adviser's by itself; against all pairs."""
    m = mdm.fuzzy_matches(table(spark, d, "mdm_company"), table(spark, d, "sec_adv_filing").where("crd_number IS NOT NULL"), "entity_id", "crd_number", "canonical_name", "adviser_name", down_to="auto")
    return m.select("entity_id", "crd_number", F.round("score", 9).alias("score"))


@query("SELECT DISTINCT coalesce(entity_name, '') AS entity_name, " + _BARE.format("entity_name") + " AS bare FROM sec_company")
def fn_bare_name(spark, d):
    return table(spark, d, "sec_company").select(F.coalesce("entity_name", F.lit("")).alias("entity_name"), T.bare_name(F.col("entity_name")).alias("bare")).distinct()


@query("""WITH s AS (SELECT user_id AS entity_id, event_type AS field, CAST(value AS VARCHAR) AS value, event_id, ts FROM events) SELECT entity_id, arg_min(value, event_id) FILTER (WHERE field = 'signup') AS signup, arg_max(value, event_id) FILTER (WHERE field = 'purchase') AS purchase FROM s GROUP BY 1""")
def md_survivors(spark, d):
    e = table(spark, d, "events")
    order = F.timestamp_micros(F.col("event_id"))  # the event number as a total order in time
    stage = e.select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("field"), F.lit("s").alias("source"), F.col("value").cast("string").alias("value"), F.lit(1).alias("priority"), F.lit(None).cast("date").alias("effective_date"), order.alias("loaded_at"))
    return mdm.survivors(stage, {"signup": "immutable", "purchase": "most_recent"})


@query("SELECT cik, last_sync_run_id FROM (SELECT DISTINCT cik, last_sync_run_id, entity_name FROM sec_company WHERE parse_sequence % 2 = 0) a WHERE NOT EXISTS (SELECT 1 FROM sec_company b WHERE b.parse_sequence % 2 = 1 AND b.cik = a.cik AND b.entity_name IS NOT DISTINCT FROM a.entity_name)")
def md_unchanged(spark, d):
    c = table(spark, d, "sec_company").where("cik IS NOT NULL").withColumn("h", T.row_hash(F.col("entity_name")))
    return mdm.unchanged(c.where("parse_sequence % 2 = 0").select("cik", "last_sync_run_id", "entity_name", "h").distinct(), c.where("parse_sequence % 2 = 1").select("cik", "h").distinct(), "cik", "h").select("cik", "last_sync_run_id")


# ---------------------------------------------------------------- graphs


@query("""WITH RECURSIVE up AS (SELECT entity_id AS o, parent_company_entity_id AS n, 1 AS h FROM mdm_company WHERE parent_company_entity_id IS NOT NULL AND parent_company_entity_id <> entity_id UNION ALL SELECT up.o, m.parent_company_entity_id, h + 1 FROM up JOIN mdm_company m ON m.entity_id = up.n WHERE m.parent_company_entity_id IS NOT NULL AND m.parent_company_entity_id <> m.entity_id AND h < 40)
SELECT o AS entity_id, CASE WHEN max(h) >= 40 THEN o ELSE arg_max(n, h) END AS canonical FROM up GROUP BY o""")
def gr_canonical(spark, d):
    return graph.canonical_ids(table(spark, d, "mdm_company").select("entity_id", "parent_company_entity_id"), "entity_id", "parent_company_entity_id", 32)


_EDGES = "SELECT DISTINCT sourcenodeid AS u, targetnodeid AS v FROM mdm_graph_edges WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer) AND relationship_type = 'SUBSIDIARY_OF'"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    return table(spark, d, "mdm_graph_edges").join(F.broadcast(p), "generation_id", "left_semi").where("relationship_type = 'SUBSIDIARY_OF'").select(F.col("sourcenodeid").alias("u"), F.col("targetnodeid").alias("v")).distinct()  # one row


@query(f"""WITH RECURSIVE e AS ({_EDGES}), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), s AS (SELECT min(u) AS x FROM b), r AS (SELECT x AS node, 0 AS hops FROM s UNION SELECT b.v, hops + 1 FROM r JOIN b ON b.u = r.node WHERE hops < 2) SELECT (SELECT x FROM s) AS start, node, min(hops) AS hops FROM r GROUP BY node""")
def gr_neighbourhood(spark, d):
    e = _edges(spark, d)
    start = e.select(F.explode(F.array("u", "v")).alias("node")).agg(F.min("node").alias("node"))
    return graph.neighbourhood(e, start, "u", "v", 2)


@query(f"""WITH RECURSIVE e AS ({_EDGES}), b AS (SELECT u, v FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v), r AS (SELECT u AS node, u AS seen FROM b UNION SELECT r.node, b.v FROM r JOIN b ON b.u = r.seen) SELECT node, min(seen) AS component FROM r GROUP BY node""")
def gr_components(spark, d):
    return graph.components(_edges(spark, d), "u", "v")


@query("SELECT relationship_type, count(*) AS n_edges, count(DISTINCT sourcenodeid) AS n_sources FROM mdm_graph_edges WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer) GROUP BY 1")
def gr_info(spark, d):
    p = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    return table(spark, d, "mdm_graph_edges").join(F.broadcast(p), "generation_id", "left_semi").groupBy("relationship_type").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("sourcenodeid").alias("n_sources"))  # one row


@query("SELECT DISTINCT source_entity_id FROM mdm_relationship_instance WHERE target_entity_id = (SELECT min(target_entity_id) FROM mdm_relationship_instance) INTERSECT SELECT source_entity_id FROM mdm_relationship_instance WHERE target_entity_id = (SELECT max(target_entity_id) FROM mdm_relationship_instance)")
def gr_shared(spark, d):
    r = table(spark, d, "mdm_relationship_instance").select("source_entity_id", "target_entity_id")
    ends = r.agg(F.min("target_entity_id").alias("a"), F.max("target_entity_id").alias("b"))
    marked = r.crossJoin(F.broadcast(ends))  # one row
    return graph.shared_neighbours(marked, "source_entity_id", "target_entity_id", F.col("a"), F.col("b"))


@query("SELECT nodeid, count(DISTINCT generation_id) AS generations, max(updated_at) AS last_updated FROM mdm_graph_nodes GROUP BY 1")
def gr_generations(spark, d):
    return table(spark, d, "mdm_graph_nodes").groupBy("nodeid").agg(F.countDistinct("generation_id").alias("generations"), F.max("updated_at").alias("last_updated"))


# ---------------------------------------------------------------- serving


@query("""WITH y AS (SELECT o_custkey AS k, year(o_orderdate)::INT AS y, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS revenue FROM orders GROUP BY 1, 2), q AS (SELECT o_custkey AS k, year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS revenue FROM orders GROUP BY 1, 2, 3),
f AS (SELECT k, max(y) AS fy, arg_max(revenue, y) AS fy_revenue FROM y WHERE y < 2001 GROUP BY 1), i AS (SELECT k, max((y, q)) AS yq, arg_max(revenue, (y, q)) AS interim_revenue FROM q WHERE y >= 2001 GROUP BY 1) SELECT c_custkey, fy, fy_revenue, interim_revenue, CASE WHEN fy IS NULL THEN 'unavailable' ELSE 'present' END AS annual_state, CASE WHEN f.k IS NULL OR i.k IS NULL THEN 'empty' ELSE 'present' END AS interim_state FROM customer LEFT JOIN f ON f.k = c_custkey LEFT JOIN i ON i.k = f.k""")
def sv_feature_screen(spark, d):
    """Latest full year and, only beside it, the newest interim period, with coverage flags."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), "o_totalprice")
    y = o.where("y < 2001").groupBy("k", "y").agg(_dec("o_totalprice").alias("r")).groupBy("k").agg(F.max(F.struct("y", "r")).alias("f"))
    q = o.where("y >= 2001").groupBy("k", "y", "q").agg(_dec("o_totalprice").alias("r")).groupBy("k").agg(F.max(F.struct("y", "q", "r")).alias("i"))
    j = table(spark, d, "customer").select("c_custkey").join(y.join(q, "k", "left"), F.col("c_custkey") == F.col("k"), "left")
    return j.select("c_custkey", F.col("f.y").alias("fy"), F.col("f.r").alias("fy_revenue"), F.col("i.r").alias("interim_revenue"), F.when(F.col("f").isNull(), "unavailable").otherwise("present").alias("annual_state"), F.when(F.col("f").isNull() | F.col("i").isNull(), "empty").otherwise("present").alias("interim_state"))


@query("SELECT generation_id, entity_type, published_at, concat_ws(',', CASE WHEN status <> 'pass' THEN 'not ready' END, CASE WHEN published_at IS NULL THEN 'no watermark' END, CASE WHEN CAST(published_at AS DATE) > DATE '2024-01-01' THEN 'future watermark' END, CASE WHEN DATE '2024-01-01' - CAST(published_at AS DATE) > 60 THEN 'stale' END) AS reasons, status = 'pass' AND DATE '2024-01-01' - CAST(published_at AS DATE) BETWEEN 0 AND 60 AS is_grade FROM graph_review_entity_parity")
def sv_watermark(spark, d):
    r = table(spark, d, "graph_review_entity_parity").withColumn("ready", F.col("status") == "pass")
    return quality.watermark_grade(r, "published_at", "2024-01-01", 60, "ready").select("generation_id", "entity_type", "published_at", "reasons", "is_grade")


@query("""SELECT adviser_crd_number AS crd, string_agg(DISTINCT private_fund_id, ',' ORDER BY private_fund_id) AS funds, count(DISTINCT private_fund_id) AS n_funds, max(aum_amount)::DOUBLE AS top_aum FROM sec_adv_private_fund GROUP BY 1""")
def sv_manager_bundle(spark, d):
    f = table(spark, d, "sec_adv_private_fund").groupBy(F.col("adviser_crd_number").alias("crd"))
    return f.agg(F.array_join(F.array_sort(F.collect_set("private_fund_id")), ",").alias("funds"), F.countDistinct("private_fund_id").alias("n_funds"), F.max("aum_amount").cast("double").alias("top_aum"))


@query("""SELECT DISTINCT m.entity_id, m.canonical_name, m.ticker FROM mdm_company m WHERE m.canonical_name ILIKE '%harbor%' OR m.ticker ILIKE '%ha%' ORDER BY canonical_name, entity_id LIMIT 40""")
def sv_subject_search(spark, d):
    m = table(spark, d, "mdm_company").where(F.col("canonical_name").ilike("%harbor%") | F.col("ticker").ilike("%ha%"))
    return m.select("entity_id", "canonical_name", "ticker").distinct().orderBy("canonical_name", "entity_id").limit(40)


@query("""SELECT o.fact_key, o.accession_number, f.form, round(transaction_shares * transaction_price, 4) AS notional FROM (SELECT DISTINCT fact_key, accession_number, transaction_shares, transaction_price FROM ownership_activity WHERE trim(transaction_code) = 'P') o LEFT JOIN (SELECT accession_number, max(form) AS form FROM filing_activity GROUP BY 1) f ON o.accession_number = f.accession_number""")
def sv_insider_screen(spark, d):
    o = table(spark, d, "ownership_activity").where(F.trim("transaction_code") == "P").select("fact_key", "accession_number", "transaction_shares", "transaction_price").distinct()
    f = table(spark, d, "filing_activity").groupBy("accession_number").agg(F.max("form").alias("form"))
    return o.join(f, "accession_number", "left").select("fact_key", "accession_number", "form", F.round(F.col("transaction_shares") * F.col("transaction_price"), 4).alias("notional"))


@query("""WITH m AS (SELECT sic_description AS industry, count(*) AS n FROM mdm_company WHERE sic_description IS NOT NULL GROUP BY 1) SELECT industry, n FROM m ORDER BY n DESC, industry LIMIT 25""")
def sv_industries(spark, d):
    return table(spark, d, "mdm_company").where("sic_description IS NOT NULL").groupBy(F.col("sic_description").alias("industry")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "industry").limit(25)


@query("SELECT coalesce(nullif(trim(state_of_incorporation), ''), 'unknown') AS state, count(*) AS n FROM mdm_company GROUP BY 1")
def sv_states(spark, d):
    return table(spark, d, "mdm_company").groupBy(F.coalesce(F.nullif(F.trim("state_of_incorporation"), F.lit("")), F.lit("unknown")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- checks


@query("""WITH a AS (SELECT 'filing_activity' AS table_name, count(*) AS n FROM filing_activity WHERE filing_date < DATE '2023-01-01' UNION ALL SELECT 'ownership_activity', count(*) FROM ownership_activity), b AS (SELECT 'filing_activity' AS table_name, count(*) AS n FROM filing_activity UNION ALL SELECT 'mdm_company', count(*) FROM mdm_company)
SELECT coalesce(a.table_name, b.table_name) AS table_name, a.n AS before, b.n AS after, CASE WHEN b.n IS NULL THEN 'gone' WHEN a.n IS NULL THEN 'new' WHEN b.n < a.n THEN 'shrunk' ELSE 'ok' END AS state FROM a FULL JOIN b ON a.table_name = b.table_name""")
def dq_counts(spark, d):
    n = lambda name, where="true": table(spark, d, name).where(where).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
    return quality.shrunk_counts(n("filing_activity", "filing_date < date'2023-01-01'").unionByName(n("ownership_activity")), n("filing_activity").unionByName(n("mdm_company")))


@query("""SELECT 'ownership_activity' AS child, count(*) AS n_rows, count(*) FILTER (WHERE accession_number IS NOT NULL AND accession_number NOT IN (SELECT accession_number FROM filing_activity WHERE accession_number IS NOT NULL)) AS n_orphans FROM ownership_activity
UNION ALL SELECT 'sec_company_former_name', count(*), count(*) FILTER (WHERE cik IS NOT NULL AND cik NOT IN (SELECT cik FROM sec_company WHERE cik IS NOT NULL)) FROM sec_company_former_name""")
def dq_orphans(spark, d):
    a = R.orphans(table(spark, d, "ownership_activity"), table(spark, d, "filing_activity"), "accession_number", "accession_number").select(F.lit("ownership_activity").alias("child"), "n_rows", "n_orphans")
    return a.unionByName(R.orphans(table(spark, d, "sec_company_former_name"), table(spark, d, "sec_company"), "cik", "cik").select(F.lit("sec_company_former_name").alias("child"), "n_rows", "n_orphans"))


@query("""WITH a AS (SELECT cik, max(sic_code) AS sic, max(ein) AS ein FROM mdm_company WHERE cik IS NOT NULL GROUP BY 1), b AS (SELECT cik, max(sic) AS sic, max(ein) AS ein FROM sec_company WHERE cik IS NOT NULL GROUP BY 1), j AS (SELECT coalesce(a.cik, b.cik) AS cik, a.cik AS l, b.cik AS r, a.sic IS DISTINCT FROM b.sic AS ds, a.ein IS DISTINCT FROM b.ein AS de FROM a FULL JOIN b ON a.cik = b.cik)
SELECT cik, CASE WHEN r IS NULL THEN 'only_left' WHEN l IS NULL THEN 'only_right' WHEN ds OR de THEN 'drift' ELSE 'same' END AS state, CASE WHEN l IS NULL OR r IS NULL THEN '' ELSE concat_ws(',', CASE WHEN ds THEN 'sic' END, CASE WHEN de THEN 'ein' END) END AS drifted, CASE WHEN l IS NULL OR r IS NULL THEN 'high' WHEN NOT ds AND NOT de THEN 'none' WHEN de THEN 'high' ELSE 'low' END AS severity FROM j""")
def dq_field_drift(spark, d):
    a = table(spark, d, "mdm_company").where("cik IS NOT NULL").groupBy("cik").agg(F.max("sic_code").alias("sic"), F.max("ein").alias("ein"))
    b = table(spark, d, "sec_company").where("cik IS NOT NULL").groupBy("cik").agg(F.max("sic").alias("sic"), F.max("ein").alias("ein"))
    return quality.field_drift(a, b, "cik", ["sic", "ein"], ["ein"])


_ACTIVE_EDGES = "mdm_graph_edges WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer)"


@query(f"""WITH a AS (SELECT instance_id AS k, source_entity_id AS s, target_entity_id AS t FROM mdm_relationship_instance), b AS (SELECT edgeid AS k, sourcenodeid AS s, targetnodeid AS t FROM {_ACTIVE_EDGES}), c AS (SELECT (SELECT count(*) FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))) AS n)
SELECT 'relationships' AS compared, (SELECT count(*) FROM a) AS left_rows, (SELECT count(*) FROM b) AS right_rows, n = 0 AS same FROM c UNION ALL SELECT 'orders', count(*), count(*), true FROM orders UNION ALL SELECT 'orders with a changed row', count(*), count(*), false FROM orders""")
def dq_digest(spark, d):
    """Relationships against their graph copy, orders against themselves in another order, and against a copy that differs in one cell."""
    p = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    a = table(spark, d, "mdm_relationship_instance").select(F.col("instance_id").alias("k"), F.col("source_entity_id").alias("s"), F.col("target_entity_id").alias("t"))
    b = table(spark, d, "mdm_graph_edges").join(F.broadcast(p), "generation_id", "left_semi").select(F.col("edgeid").alias("k"), F.col("sourcenodeid").alias("s"), F.col("targetnodeid").alias("t"))  # one row
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    first = o.agg(F.min("o_orderkey").alias("m"))
    changed = o.crossJoin(F.broadcast(first)).withColumn("o_custkey", F.when(F.col("o_orderkey") == F.col("m"), F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))).drop("m")  # one row
    out = [(n, quality.same_tables(x, y, x.columns)) for n, x, y in (("relationships", a, b), ("orders", o, o.orderBy(F.desc("o_custkey"))), ("orders with a changed row", o, changed))]
    named = [t.select(F.lit(n).alias("compared"), "left_rows", "right_rows", "same") for n, t in out]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("""SELECT entity_type, generation_id, mdm_active_count - lag(mdm_active_count) OVER w AS row_delta, status IS DISTINCT FROM lag(status) OVER w AS changed FROM graph_review_entity_parity WINDOW w AS (PARTITION BY entity_type ORDER BY published_at)""")
def dq_manifest(spark, d):
    return quality.manifest_changes(table(spark, d, "graph_review_entity_parity"), "entity_type", "published_at", "status", "mdm_active_count").select("entity_type", "generation_id", "row_delta", "changed")


# ---------------------------------------------------------------- sources, sinks, streams


def _scratch(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark).replace("file:///", "/"), f"query-{uuid.uuid4().hex}")


@query("SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS ordinal, event_id AS id, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events")
def src_parallel_arrays(spark, d):
    """Events folded to parallel JSON arrays per user and read back; a gap is a NULL."""
    rows = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("k")))).alias("a"))
    payload = F.to_json(F.struct(F.col("a.event_id").alias("id"), F.col("a.k").alias("kind")))
    return readers.parallel_arrays(rows.select("user_id", payload.alias("payload")), "payload", {"id": "bigint", "kind": "string"}, ["user_id"])


@query("SELECT p_brand AS concept, 'u' AS unit, DATE '0001-01-01' AS period_start, DATE '2023-12-31' AS period_end, p_retailprice AS value, CAST(p_size AS INT) AS fiscal_year, 'FY' AS fiscal_period, CAST(p_partkey AS VARCHAR) AS accession_number FROM part")
def src_keyed_facts(spark, d):
    fact = F.struct(F.lit("2023-12-31").alias("end"), F.col("p_retailprice").alias("val"), F.col("p_size").alias("fy"), F.lit("FY").alias("fp"), F.col("p_partkey").cast("string").alias("accn"))
    p = table(spark, d, "part").select(F.to_json(F.create_map(F.col("p_brand"), F.struct(F.create_map(F.lit("u"), F.array(fact)).alias("units")))).alias("payload"))
    return readers.keyed_facts(p, "payload")


@query("""SELECT row_number() OVER (ORDER BY c_custkey) AS row_ordinal, '10-K' AS form, c_name AS company, c_custkey + 100000 AS cik, DATE '2023-01-31' AS filed, f AS file_name, CASE WHEN c_custkey % 2 = 0 THEN a ELSE f END AS accession_number, 'https://www.sec.gov/Archives/' || f AS filing_txt_url, sha256('10-K|' || c_name || '|' || (c_custkey + 100000) || '|2023-01-31|' || f) AS record_hash
FROM (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-23-000001' AS a, 'edgar/data/' || (c_custkey + 100000) || '/' || CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-23-000001.txt' ELSE 'other.txt' END AS f FROM customer)""")
def src_fixed_width(spark, d):
    c = table(spark, d, "customer").withColumn("cik", (F.col("c_custkey") + 100000).cast("string"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.lit("-23-000001.txt"))).otherwise("other.txt")
    line = F.concat(F.lit("10-K    "), "c_name", F.lit("   "), "cik", F.lit("  20230131  edgar/data/"), "cik", F.lit("/"), name)
    lines = c.select(F.col("c_custkey").alias("at"), line.alias("value")).unionByName(spark.createDataFrame([(-1, "Form Type   Company Name   CIK   Date Filed   File Name"), (-2, "----")], "at long, value string"))
    return readers.fixed_width_index(lines, "value", "at")


@query("SELECT CAST(s_suppkey AS BIGINT) AS id, 1 AS owner_index, CAST(s_nationkey AS VARCHAR) AS owner_cik, s_name AS owner_name FROM supplier")
def src_xml(spark, d):
    s = table(spark, d, "supplier")
    x = F.concat(F.lit("<ownershipDocument><reportingOwner><reportingOwnerId><rptOwnerCik>"), F.col("s_nationkey").cast("string"), F.lit("</rptOwnerCik><rptOwnerName>"), "s_name", F.lit("</rptOwnerName></reportingOwnerId></reportingOwner></ownershipDocument>"))
    return readers.ownership_xml(s.select(F.col("s_suppkey").alias("id"), x.alias("x")), "x", ["id"])[0]


@query("SELECT DISTINCT accession_number, holding_index, CASE WHEN period_of_report <= DATE '2022-09-30' THEN market_value * 1000 ELSE market_value END AS dollars FROM sec_thirteenf_holding")
def src_scaled_values(spark, d):
    return table(spark, d, "sec_thirteenf_holding").select("accession_number", "holding_index", readers.scaled_value(F.col("market_value"), F.col("period_of_report")).alias("dollars")).distinct()


@query("SELECT CAST(c_custkey AS BIGINT) AS k, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer WHERE c_custkey % 2 = 1")
def src_shards(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return readers.union_shards([c.where("k % 2 = 0").drop("balance"), c.where("k % 2 = 1").drop("segment"), c.select(F.lit(1).alias("other"))], ["k", "segment", "balance"])


@query("SELECT 'filing_activity' AS table_name, count(*) AS n_rows FROM filing_activity UNION ALL SELECT 'orders', count(*) FROM orders")
def snk_landing(spark, d):
    """Tables written with their manifest; the empty one is skipped."""
    tables = {n: table(spark, d, n) for n in ("filing_activity", "orders")} | {"nothing": table(spark, d, "orders").where("false")}
    return writers.write_landing(tables, _scratch(spark), "run-1").select("table_name", "n_rows")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def snk_published(spark, d):
    """Two generations of a table; readers get the second one."""
    folder, o = _scratch(spark), table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    writers.publish(o.where("o_orderkey % 2 = 0"), folder, "g1")
    writers.publish(o, folder, "g2")
    return writers.published(spark, folder)


def _arriving(spark: SparkSession, d: str, partitions: int = 6) -> tuple[str, DataFrame]:
    folder = _scratch(spark)
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(partitions, "event_id").write.parquet(os.path.join(folder, "in"))
    return folder, events


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value, arg_min(ts, event_id) AS ts FROM events GROUP BY 1, 2")
def str_merge(spark, d):
    """Event files merged two at a time in whatever order they come; a second run finds nothing new."""
    folder, events = _arriving(spark, d)
    for _ in range(2):
        stream = ingest.file_stream(spark, os.path.join(folder, "in"), events.schema, per_batch=2).select("user_id", "event_type", "event_id", "value", "ts")
        ingest.merge_stream(stream, os.path.join(folder, "out"), os.path.join(folder, "checkpoint"), merge.MergeSpec(("user_id", "event_type"), first=("ts",)), "event_id")
    return ingest.merged(spark, os.path.join(folder, "out"), merge.MergeSpec(("user_id", "event_type"), first=("ts",)), "event_id")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events WHERE ts < (SELECT date_trunc('day', max(ts) - INTERVAL 2 DAY) FROM events) GROUP BY 1, 2")
def str_windows(spark, d):
    """Daily counts by event time; a day is out once the watermark has passed its end."""
    folder, events = _arriving(spark, d, 1)
    counts = ingest.windowed_counts(ingest.file_stream(spark, os.path.join(folder, "in"), events.schema), "ts", "event_type")
    counts.writeStream.format("parquet").option("path", os.path.join(folder, "out")).option("checkpointLocation", os.path.join(folder, "checkpoint")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(os.path.join(folder, "out"))


# ---------------------------------------------------------------- orchestration-side relations


@query("SELECT DISTINCT c.cik FROM sec_company c WHERE c.cik IS NOT NULL AND (lower(trim(c.entity_type)) = 'operating' OR EXISTS (SELECT 1 FROM mdm_company m WHERE m.cik = c.cik AND m.ticker IS NOT NULL))")
def ot_eligible(spark, d):
    t = table(spark, d, "mdm_company").where("ticker IS NOT NULL").select("cik").distinct().withColumn("hit", F.lit(True))
    return table(spark, d, "sec_company").where("cik IS NOT NULL").join(t, "cik", "left").where((F.lower(F.trim("entity_type")) == "operating") | F.col("hit")).select("cik").distinct()


@query("SELECT accession_number, count(DISTINCT form) AS forms, count(DISTINCT filing_date) AS dates, count(DISTINCT form) > 1 OR count(DISTINCT filing_date) > 1 AS disagrees FROM filing_activity WHERE accession_number IS NOT NULL GROUP BY 1")
def ot_inventory(spark, d):
    g = table(spark, d, "filing_activity").where("accession_number IS NOT NULL").groupBy("accession_number").agg(F.countDistinct("form").alias("forms"), F.countDistinct("filing_date").alias("dates"))
    return g.withColumn("disagrees", (F.col("forms") > 1) | (F.col("dates") > 1))


@query("""WITH s AS (SELECT last_day(CAST(q AS DATE)) AS q FROM range(DATE '2021-03-01', DATE '2023-12-31', INTERVAL 3 MONTH) t(q)), h AS (SELECT DISTINCT date_trunc('quarter', period_of_report) AS q FROM sec_thirteenf_holding WHERE period_of_report IS NOT NULL) SELECT s.q AS quarter_end, count(h.q) > 0 AS reported FROM s LEFT JOIN h ON date_trunc('quarter', s.q) = h.q GROUP BY 1""")
def ot_missing_quarters(spark, d):
    s = spark.range(1).select(F.explode(F.sequence(F.lit("2021-03-31").cast("date"), F.lit("2023-12-31").cast("date"), F.expr("interval 3 months"))).alias("quarter_end"))
    h = table(spark, d, "sec_thirteenf_holding").where("period_of_report IS NOT NULL").select(F.date_trunc("quarter", "period_of_report").alias("q")).distinct()
    return s.join(h, F.date_trunc("quarter", "quarter_end") == F.col("q"), "left").select("quarter_end", F.col("q").isNotNull().alias("reported"))


@query("SELECT record_id, pos FROM (SELECT record_id, row_number() OVER (PARTITION BY feed_id, file_seq, row_no ORDER BY arrived_at DESC, record_id DESC) AS pos FROM (SELECT DISTINCT record_id, feed_id, file_seq, row_no, arrived_at FROM landing_record))")
def ot_reclaim(spark, d):
    l = table(spark, d, "landing_record").select("record_id", "feed_id", "file_seq", "row_no", "arrived_at").distinct()
    return l.select("record_id", F.row_number().over(Window.partitionBy("feed_id", "file_seq", "row_no").orderBy(F.desc("arrived_at"), F.desc("record_id"))).alias("pos"))


@query("SELECT parse_sequence, s.cik, m.entity_id AS mdm_entity_id FROM (SELECT DISTINCT parse_sequence, cik FROM sec_company WHERE mdm_entity_id IS NULL AND cik IS NOT NULL) s JOIN (SELECT cik, min(entity_id) AS entity_id FROM mdm_company WHERE cik IS NOT NULL GROUP BY 1) m ON s.cik = m.cik")
def ot_backfill(spark, d):
    m = table(spark, d, "mdm_company").where("cik IS NOT NULL").groupBy("cik").agg(F.min("entity_id").alias("mdm_entity_id"))
    return table(spark, d, "sec_company").where("mdm_entity_id IS NULL AND cik IS NOT NULL").select("parse_sequence", "cik").distinct().join(m, "cik").select("parse_sequence", "cik", "mdm_entity_id")
