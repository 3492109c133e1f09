"""Queries of the relational operators: projection, filters, joins, aggregates, windows, sorting, sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.operators import merge, relational as R
from cairnflow.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- projection and filters


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def prj_explicit(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("order_date"))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def flt_equal(spark, d):
    return table(spark, d, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


def optional_filters(df: DataFrame, least: float | None = None, status: str = "all") -> DataFrame:
    """Predicates only for the parameters that are given."""
    if least is not None:
        df = df.where(F.col("o_totalprice") >= least)
    return df if status == "all" else df.where(F.col("o_orderstatus") == status)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000")
def flt_optional(spark, d):
    return optional_filters(table(spark, d, "orders"), 250000.0).select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%an%' OR p_type ILIKE '%steel%'")
def flt_search(spark, d):
    return table(spark, d, "part").where(F.col("p_name").ilike("%an%") | F.col("p_type").ilike("%steel%")).select("p_partkey", "p_name")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - INTERVAL 5 YEAR")
def flt_relative_date(spark, d):
    return table(spark, d, "orders").where(F.to_date("o_orderdate") >= F.add_months(F.lit("2001-08-01").cast("date"), -60)).select("o_orderkey")


@query("SELECT fact_key, form FROM filing_activity WHERE (form IN ('10-K', '10-Q') OR form LIKE '8-K%') AND filing_date >= DATE '2022-01-01'")
def flt_forms(spark, d):
    f = table(spark, d, "filing_activity")
    return f.where((F.col("form").isin("10-K", "10-Q") | F.col("form").like("8-K%")) & (F.col("filing_date") >= F.lit("2022-01-01").cast("date"))).select("fact_key", "form")


@query("SELECT fact_key FROM filing_activity WHERE (filing_date, accession_number) > (DATE '2022-06-30', '0001')")
def flt_row_value(spark, d):
    return table(spark, d, "filing_activity").where(F.struct(F.col("filing_date"), F.col("accession_number")) > F.struct(F.lit("2022-06-30").cast("date"), F.lit("0001"))).select("fact_key")


@query("SELECT entity_id FROM mdm_company WHERE ticker IS NOT DISTINCT FROM primary_ticker")
def flt_null_safe(spark, d):
    return table(spark, d, "mdm_company").where(F.col("ticker").eqNullSafe(F.col("primary_ticker"))).select("entity_id")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50")
def flt_capped(spark, d):
    asked, most = 500, 50
    return table(spark, d, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(min(max(asked, 1), most)).select("c_custkey", "c_acctbal")


# ---------------------------------------------------------------- joins


@query("SELECT l_orderkey, o_custkey, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def jn_inner(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey", "o_custkey").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@query("""SELECT c_custkey, coalesce(n_name, 'unknown') AS nation, coalesce(r_name, 'unknown') AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def jn_left_chain(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    j = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"), F.coalesce("r_name", F.lit("unknown")).alias("region"))


@query("""WITH a AS (SELECT l_suppkey AS s, l_partkey AS p, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), b AS (SELECT l_suppkey AS s, l_partkey AS p, count(*) AS m FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2)
SELECT a.s AS suppkey, a.p AS partkey, n AS returned, coalesce(m, 0) AS kept FROM a LEFT JOIN b ON a.s = b.s AND a.p = b.p""")
def jn_composite(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("suppkey"), F.col("l_partkey").alias("partkey"), "l_returnflag")
    a = l.where("l_returnflag = 'R'").groupBy("suppkey", "partkey").agg(F.count(F.lit(1)).alias("returned"))
    b = l.where("l_returnflag <> 'R'").groupBy("suppkey", "partkey").agg(F.count(F.lit(1)).alias("kept"))
    return a.join(b, ["suppkey", "partkey"], "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


@query("""WITH a AS (SELECT adviser_crd_number AS crd, count(DISTINCT private_fund_id) AS funds FROM sec_adv_private_fund GROUP BY 1), b AS (SELECT crd_number AS crd, count(DISTINCT accession_number) AS filings FROM sec_adv_filing WHERE adviser_name IS NOT NULL GROUP BY 1)
SELECT coalesce(a.crd, b.crd) AS crd, coalesce(funds, 0) AS funds, coalesce(filings, 0) AS filings, coalesce(funds, 0) - coalesce(filings, 0) AS delta FROM a FULL JOIN b ON a.crd = b.crd""")
def jn_full_reconcile(spark, d):
    a = table(spark, d, "sec_adv_private_fund").groupBy(F.col("adviser_crd_number").alias("crd")).agg(F.countDistinct("private_fund_id").alias("funds"))
    b = table(spark, d, "sec_adv_filing").where("adviser_name IS NOT NULL").groupBy(F.col("crd_number").alias("crd")).agg(F.countDistinct("accession_number").alias("filings"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return a.join(b, "crd", "full").select("crd", zero("funds").alias("funds"), zero("filings").alias("filings"), (zero("funds") - zero("filings")).alias("delta"))


_YEARLY = "SELECT o_custkey AS custkey, year(o_orderdate)::INT AS y, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS revenue FROM orders GROUP BY 1, 2"


def yearly(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query(f"WITH b AS ({_YEARLY}) SELECT b.custkey, b.y, b.revenue, p.revenue AS revenue_prior, q.revenue AS revenue_3 FROM b LEFT JOIN b p ON p.custkey = b.custkey AND p.y = b.y - 1 LEFT JOIN b q ON q.custkey = b.custkey AND q.y = b.y - 3")
def jn_shifted_self(spark, d):
    b = yearly(spark, d)
    return R.shifted(R.shifted(b, ["custkey"], "y", 1, ["revenue"], "_prior"), ["custkey"], "y", 3, ["revenue"], "_3").select("custkey", "y", "revenue", "revenue_prior", "revenue_3")


@query("SELECT entity_id, active_generation_id FROM mdm_company CROSS JOIN graph_active_pointer")
def jn_cross_status(spark, d):
    return table(spark, d, "mdm_company").select("entity_id").crossJoin(F.broadcast(table(spark, d, "graph_active_pointer").select("active_generation_id")))  # one row


@query("""WITH a AS (SELECT c_nationkey AS nation FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5), b AS (SELECT c_mktsegment AS segment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
SELECT nation, segment, count(c_custkey) AS n FROM a CROSS JOIN b LEFT JOIN customer ON c_nationkey = nation AND c_mktsegment = segment GROUP BY 1, 2""")
def jn_heat_map(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    top = lambda k, n: c.groupBy(k).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), k).limit(n).select(k)
    return top("nation", 5).crossJoin(top("segment", 3)).join(c, ["nation", "segment"], "left").groupBy("nation", "segment").agg(F.count("c_custkey").alias("n"))  # five by three


@query("""SELECT DISTINCT instance_id FROM mdm_relationship_instance WHERE source_entity_id IN (SELECT entity_id FROM mdm_company WHERE state_of_incorporation = 'NY') OR target_entity_id IN (SELECT entity_id FROM mdm_company WHERE state_of_incorporation = 'NY')""")
def jn_semi_either(spark, d):
    keys = table(spark, d, "mdm_company").where("state_of_incorporation = 'NY'")
    return R.member_of_any(table(spark, d, "mdm_relationship_instance").select("instance_id", "source_entity_id", "target_entity_id"), ["source_entity_id", "target_entity_id"], keys, "entity_id").select("instance_id").distinct()


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS has_finished FROM customer")
def jn_exists_flag(spark, d):
    keys = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    return table(spark, d, "customer").join(keys, "c_custkey", "left").select("c_custkey", F.col("hit").isNotNull().alias("has_finished"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def jn_anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""SELECT o_orderkey FROM orders a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = '1-URGENT' AND (b.o_orderdate, b.o_orderkey) > (a.o_orderdate, a.o_orderkey))""")
def jn_theta_anti(spark, d):
    """No later urgent order of the same customer: by the latest one per customer, not by pairs."""
    o = table(spark, d, "orders")
    last = o.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("last"))
    j = o.join(last, "o_custkey", "left")
    return j.where(F.col("last").isNull() | ~(F.col("last") > F.struct("o_orderdate", "o_orderkey"))).select("o_orderkey")


@query("""SELECT 'edge without source' AS problem, instance_id AS id FROM mdm_relationship_instance r LEFT JOIN mdm_company c ON r.source_entity_id = c.entity_id WHERE c.entity_id IS NULL
UNION ALL SELECT 'edge without target', instance_id FROM mdm_relationship_instance r LEFT JOIN mdm_company c ON r.target_entity_id = c.entity_id WHERE c.entity_id IS NULL""")
def jn_anti_left_null(spark, d):
    r, c = table(spark, d, "mdm_relationship_instance"), table(spark, d, "mdm_company").select("entity_id")
    part = lambda side, label: r.join(c, r[side] == c["entity_id"], "left_anti").select(F.lit(label).alias("problem"), F.col("instance_id").alias("id"))
    return part("source_entity_id", "edge without source").unionByName(part("target_entity_id", "edge without target"))


_PARENTS = "SELECT parent_company_entity_id FROM mdm_company"


@query(f"SELECT 'sql' AS rule, entity_id FROM mdm_company WHERE entity_id NOT IN ({_PARENTS}) UNION ALL SELECT 'sql, known keys', ticker FROM mdm_company WHERE ticker NOT IN (SELECT ticker FROM mdm_company WHERE ticker < 'M') UNION ALL SELECT 'keep', ticker FROM mdm_company WHERE ticker IS NULL OR ticker NOT IN (SELECT ticker FROM mdm_company WHERE ticker < 'M') UNION ALL SELECT 'drop', entity_id FROM mdm_company WHERE entity_id NOT IN ({_PARENTS} WHERE parent_company_entity_id IS NOT NULL)")
def jn_not_in_nullable(spark, d):
    """NOT IN over keys that hold NULLs: by SQL's rule none is left; by the others NULL keys don't count."""
    c = table(spark, d, "mdm_company")
    low = c.where("ticker < 'M'")
    one = lambda rule, df, column: df.select(F.lit(rule).alias("rule"), F.col(column).alias("entity_id"))
    a = one("sql", R.not_among(c, "entity_id", c, "parent_company_entity_id"), "entity_id").unionByName(one("sql, known keys", R.not_among(c.select("ticker"), "ticker", low.select(F.col("ticker").alias("t")), "t"), "ticker"))
    b = one("keep", R.not_among(c.select("ticker"), "ticker", low.select(F.col("ticker").alias("t")), "t", "keep"), "ticker").unionByName(one("drop", R.not_among(c, "entity_id", c, "parent_company_entity_id", "drop"), "entity_id"))
    return a.unionByName(b)


@query("SELECT o_orderkey, o_totalprice, (SELECT max(o_totalprice) FROM orders) AS top_price FROM orders WHERE o_orderpriority = '1-URGENT'")
def jn_scalar(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice").crossJoin(F.broadcast(o.agg(F.max("o_totalprice").alias("top_price"))))  # one row


@query("SELECT DISTINCT nodeid FROM mdm_graph_nodes JOIN graph_active_pointer ON generation_id = active_generation_id")
def jn_pointer(spark, d):
    p = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    return table(spark, d, "mdm_graph_nodes").join(F.broadcast(p), "generation_id").select("nodeid").distinct()  # one row


_SPANS = "SELECT source_entity_id AS e, relationship_id AS r, instance_id AS i, valid_from_date AS f, valid_to_date AS t FROM mdm_relationship_instance WHERE is_active AND rel_type_name = '{}'"


@query(f"WITH a AS ({_SPANS.format('HOLDS')}), b AS ({_SPANS.format('EMPLOYS')}) SELECT a.i AS holds_id, b.i AS employs_id FROM a JOIN b ON a.e = b.e WHERE (b.t IS NULL OR a.f IS NULL OR a.f < b.t) AND (a.t IS NULL OR b.f IS NULL OR b.f < a.t)")
def jn_interval(spark, d):
    r = table(spark, d, "mdm_relationship_instance").where("is_active")
    side = lambda k: r.where(F.col("rel_type_name") == k).select(F.col("source_entity_id").alias("e"), F.col("instance_id").alias("i"), F.col("valid_from_date").alias("f"), F.col("valid_to_date").alias("t"))
    return R.overlapping(side("HOLDS"), side("EMPLOYS"), ["e"], "f", "t", "f", "t").select(F.col("a.i").alias("holds_id"), F.col("b.i").alias("employs_id"))


@query("""SELECT o.fact_key, o.company_key, o.date_key, (SELECT max(f.date_key) FROM filing_activity f WHERE f.company_key = o.company_key AND f.date_key <= o.date_key) AS last_filed FROM (SELECT DISTINCT fact_key, company_key, date_key FROM ownership_activity) o""")
def jn_as_of(spark, d):
    o = table(spark, d, "ownership_activity").select("fact_key", "company_key", "date_key").distinct()
    f = table(spark, d, "filing_activity").where("date_key IS NOT NULL").select("company_key", "date_key", F.col("date_key").alias("last_filed"))
    return R.as_of(o, f, ["company_key"], "date_key", "date_key", ["last_filed"])


@query("SELECT instance_id FROM mdm_relationship_instance WHERE (valid_from_date IS NULL OR valid_from_date <= DATE '2022-06-30') AND (valid_to_date IS NULL OR valid_to_date > DATE '2022-06-30')")
def jn_valid_at(spark, d):
    return R.valid_at(table(spark, d, "mdm_relationship_instance"), F.lit("2022-06-30").cast("date"), "valid_from_date", "valid_to_date").select("instance_id")


@query("""WITH f AS (SELECT cik, min(accession_number) AS first_accession FROM filing_activity WHERE cik IS NOT NULL GROUP BY 1) SELECT entity_id, first_accession FROM mdm_company m LEFT JOIN f ON m.cik = f.cik""")
def jn_first_per_key(spark, d):
    f = table(spark, d, "filing_activity").where("cik IS NOT NULL").groupBy("cik").agg(F.min("accession_number").alias("first_accession"))
    return table(spark, d, "mdm_company").select("entity_id", "cik").join(f, "cik", "left").select("entity_id", "first_accession")


# ---------------------------------------------------------------- aggregates


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS sum_qty, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS sum_price, max(l_discount) AS max_discount, min(l_tax) AS min_tax FROM lineitem GROUP BY 1, 2""")
def ag_group(spark, d):
    s = lambda c, n: F.sum(F.col(c).cast("decimal(18,2)")).cast("double").alias(n)
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), s("l_quantity", "sum_qty"), s("l_extendedprice", "sum_price"), F.max("l_discount").alias("max_discount"), F.min("l_tax").alias("min_tax"))


@query("SELECT (SELECT count(*) FROM mdm_company) AS companies, (SELECT count(*) FROM filing_activity) AS filings, (SELECT max(filing_date) FROM filing_activity) AS last_filed")
def ag_kpi_row(spark, d):
    f = table(spark, d, "filing_activity").agg(F.count(F.lit(1)).alias("filings"), F.max("filing_date").alias("last_filed"))
    return table(spark, d, "mdm_company").agg(F.count(F.lit(1)).alias("companies")).crossJoin(f)  # one row each


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def ag_distinct(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"))


@query("SELECT strftime(filing_date, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (WHERE is_xbrl) AS n_xbrl FROM filing_activity WHERE filing_date IS NOT NULL GROUP BY 1")
def ag_conditional(spark, d):
    return table(spark, d, "filing_activity").where("filing_date IS NOT NULL").groupBy(F.date_format("filing_date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_xbrl").alias("n_xbrl"))


@query("SELECT r_name, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def ag_list(spark, d):
    j = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("nations"))


_HASH = "((('0x' || substr(sha256({}), 1, 16))::UBIGINT) & 9223372036854775807)::BIGINT"


_ROW = "concat_ws('|', CAST(c_custkey AS VARCHAR), c_mktsegment, c_name)"


@query(f"SELECT count(*) AS n_rows, CAST(sum(CAST({_HASH.format(_ROW)} AS DECIMAL(38,0))) AS VARCHAR) AS digest FROM customer")
def ag_digest(spark, d):
    return merge.table_digest(table(spark, d, "customer"), ["c_custkey", "c_mktsegment", "c_name"])


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def ag_time_bucket(spark, d):
    return table(spark, d, "events").groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_known, round(count({c}) / count(*), 9) AS known_ratio FROM mdm_company" for c in ("cik", "ticker", "ein", "state_of_incorporation", "valid_to")))
def ag_coverage(spark, d):
    return R.coverage(table(spark, d, "mdm_company"), ["cik", "ticker", "ein", "state_of_incorporation", "valid_to"]).withColumn("known_ratio", F.round("known_ratio", 9))


@query("SELECT DISTINCT form FROM filing_activity WHERE form IS NOT NULL")
def ag_distinct_dim(spark, d):
    return table(spark, d, "filing_activity").where("form IS NOT NULL").select("form").distinct()


@query("""WITH c AS (SELECT DISTINCT cik FROM filing_activity WHERE cik IS NOT NULL) SELECT state_of_incorporation AS state, count(*) AS universe, count(c.cik) AS covered, CASE WHEN count(*) >= 10 THEN round(count(c.cik) / count(*), 9) END AS rate FROM mdm_company m LEFT JOIN c ON m.cik = c.cik GROUP BY 1""")
def ag_coverage_rate(spark, d):
    c = table(spark, d, "filing_activity").where("cik IS NOT NULL").select("cik").distinct().withColumn("hit", F.lit(1))
    g = table(spark, d, "mdm_company").join(c, "cik", "left").groupBy(F.col("state_of_incorporation").alias("state")).agg(F.count(F.lit(1)).alias("universe"), F.count("hit").alias("covered"))
    return g.withColumn("rate", F.when(F.col("universe") >= 10, F.round(F.col("covered") / F.col("universe"), 9)))


@query("""SELECT 'company' AS domain, (SELECT count(DISTINCT cik) FROM sec_company) AS silver, (SELECT count(DISTINCT cik) FROM mdm_company) AS golden, (SELECT count(DISTINCT cik) FROM sec_company) - (SELECT count(DISTINCT cik) FROM mdm_company) AS gap
UNION ALL SELECT 'adviser', (SELECT count(DISTINCT adviser_crd_number) FROM sec_adv_private_fund), (SELECT count(DISTINCT crd_number) FROM sec_adv_filing), (SELECT count(DISTINCT adviser_crd_number) FROM sec_adv_private_fund) - (SELECT count(DISTINCT crd_number) FROM sec_adv_filing)""")
def ag_domain_gap(spark, d):
    def gap(label, a, ka, b, kb):
        return table(spark, d, a).agg(F.countDistinct(ka).alias("silver")).crossJoin(table(spark, d, b).agg(F.countDistinct(kb).alias("golden"))).select(F.lit(label).alias("domain"), "silver", "golden", (F.col("silver") - F.col("golden")).alias("gap"))  # one row each

    return gap("company", "sec_company", "cik", "mdm_company", "cik").unionByName(gap("adviser", "sec_adv_private_fund", "adviser_crd_number", "sec_adv_filing", "crd_number"))


@query("SELECT p_brand, count(*) FILTER (WHERE p_size < 20) AS small, count(*) FILTER (WHERE p_size >= 20 AND p_size < 40) AS middle, count(*) FILTER (WHERE p_size >= 40) AS large FROM part GROUP BY 1")
def ag_pivot(spark, d):
    band = F.when(F.col("p_size") < 20, "small").when(F.col("p_size") < 40, "middle").otherwise("large")
    return table(spark, d, "part").withColumn("band", band).groupBy("p_brand").pivot("band", ["small", "middle", "large"]).count().na.fill(0)


@query("SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1")
def ag_first_last(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"))


@query("SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def ag_rollup(spark, d):
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- windows


@query("""SELECT cik, entity_name, parse_sequence FROM (SELECT cik, entity_name, parse_sequence, row_number() OVER (PARTITION BY cik ORDER BY parse_sequence DESC, entity_name DESC NULLS LAST) AS r FROM sec_company) WHERE r = 1""")
def wn_latest(spark, d):
    return R.top_per_group(table(spark, d, "sec_company").select("cik", "entity_name", "parse_sequence"), ["cik"], [F.desc("parse_sequence"), F.desc_nulls_last("entity_name")])


@query("""SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r <= 3""")
def wn_top_k(spark, d):
    return R.top_per_group(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3)


@query("SELECT accession_number, holding_index, rank() OVER (PARTITION BY accession_number ORDER BY coalesce(market_value, 0) DESC) AS position FROM (SELECT DISTINCT accession_number, holding_index, market_value FROM sec_thirteenf_holding)")
def wn_rank(spark, d):
    h = table(spark, d, "sec_thirteenf_holding").select("accession_number", "holding_index", "market_value").distinct()
    return h.select("accession_number", "holding_index", F.rank().over(Window.partitionBy("accession_number").orderBy(F.coalesce("market_value", F.lit(0.0)).desc())).alias("position"))


_BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"


@query(f"""SELECT event_id, lag(event_type) OVER w AS previous, event_type IS DISTINCT FROM lag(event_type) OVER w AS changed, row_number() OVER w = 1 AS is_first, max(ts) OVER (PARTITION BY user_id) = ts AS is_latest,
CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS purchases, count(*) OVER (PARTITION BY user_id) AS n_events FROM events WINDOW w AS ({_BY_USER})""")
def wn_sequence(spark, d):
    w, all_ = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.lag("event_type").over(w)
    return table(spark, d, "events").select("event_id", previous.alias("previous"), (~F.col("event_type").eqNullSafe(previous)).alias("changed"), (F.row_number().over(w) == 1).alias("is_first"), (F.max("ts").over(all_) == F.col("ts")).alias("is_latest"), F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(run).cast("long").alias("purchases"), F.count(F.lit(1)).over(all_).alias("n_events"))


@query("""SELECT cik, parse_sequence, last_value(ein IGNORE NULLS) OVER (PARTITION BY cik ORDER BY parse_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ein FROM (SELECT DISTINCT cik, parse_sequence, ein FROM sec_company)""")
def wn_last_known(spark, d):
    w = Window.partitionBy("cik").orderBy("parse_sequence").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "sec_company").select("cik", "parse_sequence", "ein").distinct().select("cik", "parse_sequence", F.last("ein", ignorenulls=True).over(w).alias("ein"))


@query("SELECT canonical_name, entity_id, count(*) OVER (PARTITION BY lower(canonical_name)) > 1 AS several FROM mdm_company")
def wn_multi_match(spark, d):
    return table(spark, d, "mdm_company").select("canonical_name", "entity_id", (F.count(F.lit(1)).over(Window.partitionBy(F.lower("canonical_name"))) > 1).alias("several"))


@query("SELECT fact_key, filing_date FROM filing_activity WHERE filing_date IS NOT NULL ORDER BY filing_date DESC, fact_key LIMIT 1")
def wn_global_top(spark, d):
    return table(spark, d, "filing_activity").where("filing_date IS NOT NULL").select("fact_key", "filing_date").orderBy(F.desc("filing_date"), "fact_key").limit(1)


@query("""SELECT cik, accession_number FROM (SELECT DISTINCT cik, accession_number, report_date, row_number() OVER (PARTITION BY cik ORDER BY coalesce(quarter(report_date), 5) DESC, accession_number) AS r FROM (SELECT DISTINCT cik, accession_number, report_date FROM filing_activity WHERE cik IS NOT NULL)) WHERE r = 1""")
def wn_null_sentinel(spark, d):
    f = table(spark, d, "filing_activity").where("cik IS NOT NULL").select("cik", "accession_number", "report_date").distinct()
    return R.top_per_group(f, ["cik"], [F.coalesce(F.quarter("report_date"), F.lit(5)).desc(), F.col("accession_number")]).select("cik", "accession_number")


# ---------------------------------------------------------------- sorting and sets


@query("SELECT entity_id, ticker FROM mdm_company ORDER BY ticker DESC NULLS LAST, entity_id LIMIT 25")
def so_nulls_last(spark, d):
    return table(spark, d, "mdm_company").select("entity_id", "ticker").orderBy(F.desc_nulls_last("ticker"), "entity_id").limit(25)


@query("SELECT cik, count(*) AS n FROM filing_activity WHERE cik IS NOT NULL GROUP BY 1 ORDER BY n DESC, cik LIMIT 10")
def so_top_aggregate(spark, d):
    return table(spark, d, "filing_activity").where("cik IS NOT NULL").groupBy("cik").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cik").limit(10)


@query("SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS turn, (row_number() OVER (ORDER BY c_custkey) - 1) // 500 AS batch FROM customer")
def so_round_robin(spark, d):
    """Turn within the shard, and fixed-size batches over all: order by (turn, shard) interleaves."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    before = F.count(F.lit(1)).over(Window.partitionBy("bucket").orderBy("c_custkey").rowsBetween(Window.unboundedPreceding, -1))
    bucketed = c.withColumn("bucket", F.floor(F.col("c_custkey") / 10_000))
    totals = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per bucket
    ranked = bucketed.withColumn("within", before).join(totals.select("bucket", "base"), "bucket")
    return ranked.select("c_custkey", "c_nationkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long").alias("turn"), F.floor((F.col("base") + F.col("within")) / 500).alias("batch"))


@query("""SELECT 'shipped' AS kind, l_orderkey AS orderkey, l_partkey AS partkey FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT 'open', l_orderkey, l_partkey FROM lineitem WHERE l_linestatus <> 'F'""")
def st_union_all(spark, d):
    l = table(spark, d, "lineitem")
    part = lambda c, k: l.where(c).select(F.lit(k).alias("kind"), F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"))
    return part("l_linestatus = 'F'", "shipped").unionByName(part("l_linestatus <> 'F'", "open"))


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def st_union(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 1 INTERSECT SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 2")
def st_intersect(spark, d):
    l = table(spark, d, "lineitem")
    return l.where("l_suppkey = 1").select("l_partkey").intersect(l.where("l_suppkey = 2").select("l_partkey"))


@query("SELECT DISTINCT cik FROM sec_company WHERE cik IS NOT NULL EXCEPT SELECT cik FROM filing_activity")
def st_difference(spark, d):
    return table(spark, d, "sec_company").where("cik IS NOT NULL").select("cik").subtract(table(spark, d, "filing_activity").select("cik"))


@query("SELECT generation_id, 'fail' AS state FROM graph_review_entity_parity WHERE status = 'nothing' UNION ALL SELECT 'none' AS generation_id, 'not_ready' AS state WHERE NOT EXISTS (SELECT 1 FROM graph_review_entity_parity WHERE status = 'nothing')")
def st_fallback(spark, d):
    rows = table(spark, d, "graph_review_entity_parity").where("status = 'nothing'").select("generation_id", F.lit("fail").alias("state"))
    return R.with_fallback(rows, spark.range(1).select(F.lit("none").alias("generation_id"), F.lit("not_ready").alias("state")))


@query("SELECT user_id, event_type, min(event_id) AS first_seen FROM events GROUP BY 1, 2")
def st_ordered_dedupe(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_seen"))
