"""Queries of relationships between golden records and of the graph built of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.operators import graph
from cairnflow.operators import relations as rel
from cairnflow.operators import relational as R
from cairnflow.plans.registry import Query, registrar
from cairnflow.session import table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

EDGE = ["rel_type_name", "relationship_id", "source_id", "target_id", "valid_from", "source_accession"]


def _edge_sql(kind: str, body: str) -> str:
    """Edges of a kind from rows of s, t, p (properties that part evidence), d and a."""
    return f"SELECT '{kind}' AS rel_type_name, sha256('{kind}|' || s || '|' || t) AS relationship_id, s AS source_id, t AS target_id, min(d) AS valid_from, min(a) AS source_accession FROM ({body}) WHERE s IS NOT NULL AND t IS NOT NULL GROUP BY s, t, p"


# ---------------------------------------------------------------- derivations

_FILED = "(SELECT accession_number, min(cik) AS cik, min(report_date) AS report_date FROM filing_activity WHERE cik IS NOT NULL AND accession_number IS NOT NULL GROUP BY 1)"
_FIRM = "(SELECT cik, min(entity_id) AS entity_id FROM mdm_company WHERE cik IS NOT NULL GROUP BY 1)"
_TRADES = f"SELECT o.*, f.cik, f.report_date, m.entity_id FROM ownership_activity o JOIN {_FILED} f ON o.accession_number = f.accession_number LEFT JOIN {_FIRM} m ON f.cik = m.cik"
_CORPORATE = "party_key % 10 = 0"


def _trades(spark: SparkSession, d: str) -> DataFrame:
    """Transactions with the issuer's number, report date and golden record."""
    filed = table(spark, d, "filing_activity").where("cik IS NOT NULL AND accession_number IS NOT NULL").groupBy("accession_number").agg(F.min("cik").alias("cik"), F.min("report_date").alias("report_date"))
    return table(spark, d, "ownership_activity").join(filed, "accession_number").join(rel.first_per_key(table(spark, d, "mdm_company"), "cik", "entity_id"), "cik", "left")


def _role_flags() -> list:
    k = F.col("party_key")
    return [(k % 3) == 0, (k % 4) == 0, (k % 5) == 0]


@query(_edge_sql("IS_INSIDER", f"SELECT CAST(party_key AS VARCHAR) AS s, entity_id AS t, CASE WHEN party_key % 3 = 0 THEN 'director' WHEN party_key % 4 = 0 THEN 'officer' WHEN party_key % 5 = 0 THEN '10pct_owner' ELSE 'other' END AS p, report_date AS d, accession_number AS a FROM ({_TRADES}) WHERE NOT coalesce({_CORPORATE}, false)"))
def rl_is_insider(spark, d):
    """Persons who filed on their holdings in a company, with one role each; owners that are companies are left out."""
    t = _trades(spark, d).where(~F.coalesce(F.expr(_CORPORATE), F.lit(False)))
    return rel.edges(t, "IS_INSIDER", F.col("party_key"), F.col("entity_id"), "ownership_filing", F.col("report_date"), F.col("accession_number"), {"role": rel.role(*_role_flags())}).select(*EDGE)


def _holds_sql(kind: str, where: str) -> str:
    return _edge_sql(kind, f"SELECT CAST(party_key AS VARCHAR) AS s, CAST(security_key AS VARCHAR) AS t, coalesce(CAST(is_derivative AS VARCHAR), '?') || '|' || coalesce(CAST(shares_owned_after AS VARCHAR), '?') AS p, report_date AS d, accession_number AS a FROM ({_TRADES}) WHERE {where}")


def _holds(spark: SparkSession, d: str, kind: str, where: str) -> DataFrame:
    t = _trades(spark, d).where(where)
    return rel.edges(t, kind, F.col("party_key"), F.col("security_key"), "ownership_filing", F.col("report_date"), F.col("accession_number"), {"shares_owned": F.col("shares_owned_after"), "is_derivative": F.col("is_derivative")}).select(*EDGE)


@query(_holds_sql("HOLDS", f"NOT ({_CORPORATE})"))
def rl_holds(spark, d):
    return _holds(spark, d, "HOLDS", f"NOT ({_CORPORATE})")


@query(_holds_sql("COMPANY_HOLDS", _CORPORATE))
def rl_company_holds(spark, d):
    return _holds(spark, d, "COMPANY_HOLDS", _CORPORATE)


@query(_edge_sql("ISSUED_BY", f"SELECT CAST(security_key AS VARCHAR) AS s, entity_id AS t, '' AS p, NULL::DATE AS d, accession_number AS a FROM ({_TRADES})"))
def rl_issued_by(spark, d):
    return rel.edges(_trades(spark, d), "ISSUED_BY", F.col("security_key"), F.col("entity_id"), "ownership_filing", None, F.col("accession_number")).select(*EDGE)


@query(_edge_sql("IS_ENTITY_OF", f"SELECT crd_number AS s, entity_id AS t, '' AS p, NULL::DATE AS d, NULL::VARCHAR AS a FROM sec_adv_filing a JOIN {_FIRM} m ON a.cik = m.cik"))
def rl_is_entity_of(spark, d):
    a = table(spark, d, "sec_adv_filing").where("cik IS NOT NULL").join(rel.first_per_key(table(spark, d, "mdm_company"), "cik", "entity_id"), "cik")
    return rel.edges(a, "IS_ENTITY_OF", F.col("crd_number"), F.col("entity_id"), "adv_filing").select(*EDGE)


@query(_edge_sql("IS_PERSON_OF", "SELECT crd_number AS s, CAST(a.cik AS VARCHAR) AS t, '' AS p, NULL::DATE AS d, NULL::VARCHAR AS a FROM sec_adv_filing a WHERE cik IN (SELECT cik FROM sec_company WHERE entity_type = 'other')"))
def rl_is_person_of(spark, d):
    people = table(spark, d, "sec_company").where("entity_type = 'other'").select("cik").distinct()
    return rel.edges(table(spark, d, "sec_adv_filing").join(people, "cik", "left_semi"), "IS_PERSON_OF", F.col("crd_number"), F.col("cik"), "adv_filing").select(*EDGE)


@query(_edge_sql("HAS_PARENT_COMPANY", "SELECT entity_id AS s, parent_company_entity_id AS t, '' AS p, CAST(valid_from AS DATE) AS d, NULL::VARCHAR AS a FROM mdm_company WHERE valid_to IS NULL AND parent_company_entity_id <> entity_id"))
def rl_has_parent(spark, d):
    m = table(spark, d, "mdm_company").where("valid_to IS NULL AND parent_company_entity_id <> entity_id")
    return rel.edges(m, "HAS_PARENT_COMPANY", F.col("entity_id"), F.col("parent_company_entity_id"), "mdm", F.to_date("valid_from")).select(*EDGE)


@query(_edge_sql("MANAGES_FUND", "SELECT adviser_crd_number AS s, private_fund_id AS t, coalesce(reporting_role, '?') AS p, effective_date AS d, accession_number AS a FROM sec_adv_private_fund"))
def rl_manages_fund(spark, d):
    f = table(spark, d, "sec_adv_private_fund")
    return rel.edges(f, "MANAGES_FUND", F.col("adviser_crd_number"), F.col("private_fund_id"), "adv_filing", F.col("effective_date"), F.col("accession_number"), {"role": F.col("reporting_role")}).select(*EDGE)


_13F = "SELECT cik, accession_number, period_of_report, CAST(max(ingested_at) AS DATE) AS filing_date, CASE WHEN right(accession_number, 1) IN ('1', '5') THEN 'restatement' END AS amendment_type FROM sec_thirteenf_holding WHERE cik IS NOT NULL AND accession_number IS NOT NULL GROUP BY 1, 2, 3"


@query("WITH f AS (" + _13F + ") " + _edge_sql("INSTITUTIONAL_HOLDS", "SELECT CAST(h.cik AS VARCHAR) AS s, h.cusip AS t, coalesce(h.put_call, '?') AS p, h.period_of_report AS d, h.accession_number AS a FROM sec_thirteenf_holding h JOIN f ON f.accession_number = h.accession_number AND f.cik = h.cik AND f.period_of_report = h.period_of_report WHERE NOT EXISTS (SELECT 1 FROM f l WHERE l.cik = f.cik AND l.period_of_report = f.period_of_report AND l.amendment_type = 'restatement' AND (l.filing_date, l.accession_number) > (f.filing_date, f.accession_number))"))
def rl_institutional_holds(spark, d):
    """Managers' holdings from filings that no later restatement of their period replaces: a window's greatest restatement, no theta join."""
    h = table(spark, d, "sec_thirteenf_holding").where("cik IS NOT NULL AND accession_number IS NOT NULL")
    f = h.groupBy("cik", "accession_number", "period_of_report").agg(F.to_date(F.max("ingested_at")).alias("filing_date"))
    place = F.struct("filing_date", "accession_number")
    last = F.max(F.when(F.right("accession_number", F.lit(1)).isin("1", "5"), place)).over(Window.partitionBy("cik", "period_of_report"))
    standing = f.where(F.col("period_of_report").isNotNull()).withColumn("last", last).where(F.col("last").isNull() | (place >= F.col("last"))).select("cik", "accession_number", "period_of_report")
    return rel.edges(h.join(standing, ["cik", "accession_number", "period_of_report"]), "INSTITUTIONAL_HOLDS", F.col("cik"), F.col("cusip"), "thirteenf", F.col("period_of_report"), F.col("accession_number"), {"put_call": F.col("put_call")}).select(*EDGE)


_AUDITS = "SELECT o_custkey AS cik, year(o_orderdate)::INT AS y, min(o_orderpriority) AS auditor, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1, 2"


def _audits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("y")).agg(F.min("o_orderpriority").alias("auditor"), F.to_date(F.min("o_orderdate")).alias("d"))


@query(f"WITH a AS ({_AUDITS}), b AS (SELECT *, lag(lower(trim(auditor))) OVER (PARTITION BY cik ORDER BY y) IS DISTINCT FROM lower(trim(auditor)) AS changed FROM a) SELECT cik, auditor, d AS valid_from, lead(d) OVER (PARTITION BY cik ORDER BY y) AS valid_to FROM b WHERE changed")
def rl_audited_by(spark, d):
    """Spans of one auditor per company; a change closes the span before it on the day it starts."""
    return rel.changed_spans(_audits(spark, d), "cik", "y", "auditor", "d")


_EMPLOYED = "SELECT user_id AS cik, event_id, CASE event_type WHEN 'signup' THEN 'departure' ELSE 'appointment' END AS kind, event_type AS role, CAST(ts AS DATE) AS d FROM events"


@query(f"WITH e AS ({_EMPLOYED}), n AS (SELECT *, lead(d) OVER (PARTITION BY cik ORDER BY event_id) AS until, lag(kind) OVER (PARTITION BY cik ORDER BY event_id) AS before, lag(role) OVER (PARTITION BY cik ORDER BY event_id) AS role_before FROM e) SELECT cik, role, d AS valid_from, (SELECT min(x.d) FROM n x WHERE x.cik = n.cik AND x.event_id = (SELECT min(y.event_id) FROM n y WHERE y.cik = n.cik AND y.event_id > n.event_id AND (y.kind = 'departure' OR y.role <> n.role))) AS valid_to FROM n WHERE kind = 'appointment' AND (before IS DISTINCT FROM 'appointment' OR role_before <> role)")
def rl_employed_by(spark, d):
    """Spans of employment: an appointment or another role opens one and closes the one before, a departure closes one."""
    e = table(spark, d, "events").select(F.col("user_id").alias("cik"), "event_id", F.when(F.col("event_type") == "signup", None).otherwise(F.col("event_type")).alias("role"), F.to_date("ts").alias("d"))
    w = Window.partitionBy("cik").orderBy("event_id")
    runs = e.withColumn("new", ~F.lag("role").over(w).eqNullSafe(F.col("role")) | (F.row_number().over(w) == 1)).where("new")
    return runs.withColumn("valid_to", F.lead("d").over(w)).where("role IS NOT NULL").select("cik", "role", F.col("d").alias("valid_from"), "valid_to")


@query(f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN coalesce({_CORPORATE}, false) THEN 'corporate' WHEN party_key IS NULL THEN 'unresolved_source' WHEN entity_id IS NULL THEN 'unresolved_target' ELSE 'resolved' END AS outcome FROM ({_TRADES})) GROUP BY 1")
def rl_resolution(spark, d):
    """How many transactions make an edge, and why others don't."""
    t = rel.resolution(_trades(spark, d), F.expr(_CORPORATE), F.col("party_key"), F.col("entity_id"))
    return t.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT party_key, CASE WHEN party_key % 3 = 0 THEN 'director' WHEN party_key % 4 = 0 THEN 'officer' WHEN party_key % 5 = 0 THEN '10pct_owner' ELSE 'other' END AS role FROM ownership_activity")
def rl_roles(spark, d):
    return table(spark, d, "ownership_activity").select("party_key", rel.role(*_role_flags()).alias("role")).distinct()


# ---------------------------------------------------------------- versions

_VERSION = "SELECT *, row_number() OVER (PARTITION BY k, properties, valid_from_date, valid_to_date ORDER BY instance_id) AS first FROM (SELECT rel_type_name || '|' || source_entity_id AS k, instance_id, properties, valid_from_date, valid_to_date, CASE date_provenance WHEN 'filing' THEN 1 WHEN 'derived' THEN 2 ELSE 3 END AS p FROM (SELECT DISTINCT instance_id, rel_type_name, source_entity_id, properties, valid_from_date, valid_to_date, date_provenance FROM mdm_relationship_instance))"


@query(f"""WITH v AS ({_VERSION}), u AS (SELECT *, coalesce(valid_from_date, DATE '0001-01-01') AS s, coalesce(valid_to_date, DATE '9999-12-31') AS e FROM v WHERE first = 1), c AS (SELECT a.k, a.properties, a.valid_from_date, a.valid_to_date, a.instance_id, bool_or(b.p < a.p) AS beaten, bool_or(b.p = a.p) AS tied FROM u a JOIN u b ON a.k = b.k AND a.instance_id <> b.instance_id AND b.s < a.e AND a.s < b.e AND b.p <= a.p GROUP BY ALL)
SELECT v.instance_id, v.k AS version_key, CASE WHEN first > 1 THEN 'duplicate' WHEN beaten THEN 'superseded' WHEN tied THEN 'quarantined' ELSE 'current' END AS state FROM v LEFT JOIN c ON v.instance_id = c.instance_id AND v.first = 1""")
def rl_settled_versions(spark, d):
    """One kind of relationship of an entity holds with one other at a time: which versions stand, which give way, which can't be told apart."""
    r = table(spark, d, "mdm_relationship_instance").select("instance_id", "rel_type_name", "source_entity_id", "properties", "valid_from_date", "valid_to_date", "date_provenance").distinct()
    r = r.select("instance_id", F.concat_ws("|", "rel_type_name", "source_entity_id").alias("version_key"), "properties", "valid_from_date", "valid_to_date", F.when(F.col("date_provenance") == "filing", 1).when(F.col("date_provenance") == "derived", 2).otherwise(3).alias("priority"))
    return rel.settle_versions(r, "version_key", "valid_from_date", "valid_to_date", "priority", ["instance_id"], ["properties"]).select("instance_id", "version_key", "state")


@query("WITH c AS (SELECT source_entity_id, min(valid_from_date) AS stop FROM mdm_relationship_instance WHERE quarantined GROUP BY 1) SELECT DISTINCT r.instance_id, r.valid_from_date, CASE WHEN r.valid_to_date IS NULL AND stop IS NOT NULL AND (r.valid_from_date IS NULL OR r.valid_from_date < stop) THEN stop ELSE r.valid_to_date END AS valid_to_date FROM mdm_relationship_instance r LEFT JOIN c ON r.source_entity_id = c.source_entity_id")
def rl_closed_versions(spark, d):
    """Open versions of entities with a quarantined one end where that begins."""
    r = table(spark, d, "mdm_relationship_instance").select("instance_id", "source_entity_id", "valid_from_date", "valid_to_date", "quarantined").distinct()
    c = r.where("quarantined").select("source_entity_id", F.col("valid_from_date").alias("at"))
    return rel.close_versions(r, c, "source_entity_id", "valid_from_date", "valid_to_date", "at").select("instance_id", "valid_from_date", "valid_to_date").distinct()


KINDS = ["ADVISES", "SUBSIDIARY_OF", "AUDITED_BY", "HOLDS", "EMPLOYS", "INSIDER_AT", "ISSUED_BY", "MANAGES_FUND"]


@query("SELECT k AS rel_type_name, (SELECT count(*) FROM mdm_relationship_instance WHERE rel_type_name = k) AS n_rows, CASE WHEN k = 'MANAGES_FUND' THEN 'excluded' WHEN k IN (SELECT rel_type_name FROM mdm_relationship_instance) THEN 'populated' ELSE 'valid_zero' END AS state, CASE WHEN k = 'MANAGES_FUND' THEN 'no source' END AS reason FROM unnest(" + str(KINDS) + ") t(k)")
def rl_coverage_manifest(spark, d):
    m = rel.coverage_manifest(table(spark, d, "mdm_relationship_instance"), "rel_type_name", KINDS, {"MANAGES_FUND": "no source"}, ["instance_id", "source_entity_id", "target_entity_id"])
    return m.select("rel_type_name", "n_rows", "state", "reason")


# ---------------------------------------------------------------- building the graph

_ENTITY = "SELECT entity_id, 'company' AS entity_type, coalesce(tracking_status = 'inactive', false) AS is_quarantined FROM mdm_company WHERE valid_to IS NULL UNION ALL SELECT DISTINCT 'crd:' || crd_number, 'adviser', false FROM sec_adv_filing WHERE crd_number IS NOT NULL UNION ALL SELECT DISTINCT 'fund:' || private_fund_id, 'fund', false FROM sec_adv_private_fund WHERE private_fund_id IS NOT NULL UNION ALL SELECT DISTINCT 'party:' || party_key, 'person', party_key % 50 = 0 FROM ownership_activity WHERE party_key IS NOT NULL UNION ALL SELECT DISTINCT 'security:' || security_key, 'security', false FROM ownership_activity WHERE security_key IS NOT NULL"
_GET = lambda k: f"json_extract_string(properties, '$.{k}')"


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    m, a, f, o = (table(spark, d, t) for t in ("mdm_company", "sec_adv_filing", "sec_adv_private_fund", "ownership_activity"))
    m = m.where("valid_to IS NULL")
    a = a.where("crd_number IS NOT NULL").groupBy("crd_number").agg(F.max("adviser_name").alias("canonical_name")).select(F.concat(F.lit("crd:"), "crd_number").alias("entity_id"), "crd_number", "canonical_name")
    f = f.where("private_fund_id IS NOT NULL").groupBy("private_fund_id").agg(F.max("fund_name").alias("canonical_name"), F.min("adviser_crd_number").alias("adviser")).select(F.concat(F.lit("fund:"), "private_fund_id").alias("entity_id"), "canonical_name", F.concat(F.lit("crd:"), "adviser").alias("adviser_entity_id"))
    p = o.where("party_key IS NOT NULL").select("party_key").distinct().select(F.concat(F.lit("party:"), F.col("party_key").cast("string")).alias("entity_id"), F.col("party_key").alias("owner_cik"))
    s = o.where("security_key IS NOT NULL").select("security_key").distinct().select(F.concat(F.lit("security:"), F.col("security_key").cast("string")).alias("entity_id"), F.col("security_key").alias("canonical_title"))
    kind = lambda df, name, bad=F.lit(False): df.select("entity_id", F.lit(name).alias("entity_type"), bad.alias("is_quarantined"))
    entities = kind(m, "company", F.coalesce(F.col("tracking_status") == "inactive", F.lit(False))).unionByName(kind(a, "adviser")).unionByName(kind(f, "fund")).unionByName(kind(p, "person", F.col("owner_cik") % 50 == 0)).unionByName(kind(s, "security"))
    types = spark.createDataFrame([("company", "Company", True), ("adviser", "Adviser", True), ("fund", "Fund", True), ("person", "Person", True), ("security", "Security", False)], "entity_type string, label string, is_active boolean")
    subtypes = {"company": (m, ["canonical_name", "cik", "ticker", "primary_exchange"]), "adviser": (a, ["canonical_name", "crd_number"]), "fund": (f, ["canonical_name", "adviser_entity_id"]), "person": (p, ["owner_cik"]), "security": (s, ["canonical_title"])}
    return rel.build_nodes(entities, types, subtypes, "g1")


@query(f"""WITH e AS ({_ENTITY}), c AS (SELECT entity_id, canonical_name AS name, CAST(cik AS VARCHAR) AS cik, NULL AS owner FROM mdm_company WHERE valid_to IS NULL UNION ALL SELECT 'crd:' || crd_number, max(adviser_name), NULL, NULL FROM sec_adv_filing WHERE crd_number IS NOT NULL GROUP BY 1 UNION ALL SELECT 'fund:' || private_fund_id, max(fund_name), NULL, NULL FROM sec_adv_private_fund WHERE private_fund_id IS NOT NULL GROUP BY 1 UNION ALL SELECT DISTINCT 'party:' || party_key, NULL, NULL, CAST(party_key AS VARCHAR) FROM ownership_activity WHERE party_key IS NOT NULL)
SELECT e.entity_id AS nodeid, upper(entity_type[1]) || entity_type[2:] AS label, entity_type, c.name, c.cik, c.owner, true AS has_null_ticker FROM e JOIN c ON e.entity_id = c.entity_id WHERE NOT is_quarantined AND entity_type <> 'security'""")
def gr_nodes(spark, d):
    """Nodes of every active type with the fields of their own subtype; unknown fields are kept as nulls."""
    get = lambda k: F.get_json_object("properties", f"$.{k}")
    return _nodes(spark, d).select("nodeid", "label", "entity_type", get("canonical_name").alias("name"), get("cik").alias("cik"), get("owner_cik").alias("owner"), F.array_contains(F.json_object_keys("properties"), "ticker").alias("has_null_ticker"))


@query(f"WITH e AS ({_ENTITY}) SELECT entity_type, entity_id AS nodeid FROM (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY entity_id) AS r FROM e WHERE NOT is_quarantined AND entity_type <> 'security') WHERE r <= 5")
def gr_nodes_per_type(spark, d):
    """The first five nodes of every type."""
    return R.top_per_group(_nodes(spark, d).select("entity_type", "nodeid"), ["entity_type"], [F.col("nodeid")], 5)


_LINEAGE = "(SELECT entity_id AS discarded, min(parent_company_entity_id) AS kept FROM mdm_company WHERE parent_company_entity_id IS NOT NULL GROUP BY 1)"


@query(f"""SELECT DISTINCT r.instance_id AS edgeid, coalesce(s2.kept, s1.kept, r.source_entity_id) AS sourcenodeid, coalesce(t2.kept, t1.kept, r.target_entity_id) AS targetnodeid, r.source_entity_id AS source_original, r.target_entity_id AS target_original FROM mdm_relationship_instance r
LEFT JOIN {_LINEAGE} s1 ON s1.discarded = r.source_entity_id LEFT JOIN {_LINEAGE} s2 ON s2.discarded = s1.kept LEFT JOIN {_LINEAGE} t1 ON t1.discarded = r.target_entity_id LEFT JOIN {_LINEAGE} t2 ON t2.discarded = t1.kept WHERE r.is_active""")
def gr_edges(spark, d):
    """Edges between canonical ends, through two steps of the merge lineage (here: parents), with the ends as recorded."""
    lineage = table(spark, d, "mdm_company").where("parent_company_entity_id IS NOT NULL").select(F.col("entity_id").alias("discarded_entity_id"), F.col("parent_company_entity_id").alias("kept_entity_id"))
    e = rel.build_edges(table(spark, d, "mdm_relationship_instance"), lineage, "g1")
    return e.select(F.col("instance_id").alias("edgeid"), F.col("source_entity_id").alias("sourcenodeid"), F.col("target_entity_id").alias("targetnodeid"), F.col("source_entity_id_original").alias("source_original"), F.col("target_entity_id_original").alias("target_original")).distinct()


@query("SELECT 'graph_edge_' || lower(relationship_type) AS view_name, count(*) AS n FROM mdm_graph_edges WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer) GROUP BY 1 UNION ALL SELECT 'graph_node_company', count(*) FROM mdm_graph_nodes WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer) AND entity_type = 'company' UNION ALL SELECT 'graph_node_person', 0")
def gr_typed_views(spark, d):
    """A view per node and edge type of the active generation, and how many rows each has."""
    active = table(spark, d, "graph_active_pointer").first()["active_generation_id"]  # one row
    names = rel.typed_views(table(spark, d, "mdm_graph_nodes"), table(spark, d, "mdm_graph_edges"), F.lit(active), ["company", "person"], KINDS[:6])
    out = None
    for name in (n for n in names if not n.endswith("_counts")):
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("view_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


_AS_OF = "DATE '2022-06-30'"


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT sourcenodeid AS u, targetnodeid AS v FROM mdm_graph_edges WHERE generation_id IN (SELECT active_generation_id FROM graph_active_pointer) AND relationship_type IN ('SUBSIDIARY_OF', 'HOLDS') AND (valid_from_date IS NULL OR valid_from_date <= {_AS_OF}) AND (valid_to_date IS NULL OR valid_to_date > {_AS_OF})), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), s AS (SELECT min(u) AS x FROM b), r AS (SELECT x AS node, 0 AS hops FROM s UNION SELECT b.v, hops + 1 FROM r JOIN b ON b.u = r.node WHERE hops < 3) SELECT (SELECT x FROM s) AS start, node, min(hops) AS hops FROM r GROUP BY node""")
def gr_neighbourhood_as_of(spark, d):
    """Three steps around a node over edges of two kinds that held on a day; edges without dates count."""
    p = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    e = table(spark, d, "mdm_graph_edges").join(F.broadcast(p), "generation_id", "left_semi").where("relationship_type IN ('SUBSIDIARY_OF', 'HOLDS')")  # one row
    e = R.valid_at(e, F.lit("2022-06-30").cast("date"), "valid_from_date", "valid_to_date").select(F.col("sourcenodeid").alias("u"), F.col("targetnodeid").alias("v")).distinct()
    start = e.select(F.explode(F.array("u", "v")).alias("node")).agg(F.min("node").alias("node"))
    return graph.neighbourhood(e, start, "u", "v", 3)
