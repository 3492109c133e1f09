"""Queries of the general data problems: drift, skew, parity, history, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.operators import diff, drift, history, nested, skew
from cairnflow.session import cut, table

# ---------------------------------------------------------------- schemas that drift

#: Names and types of the unified tables.
COMPANY_COLUMNS = {
    "cik": "bigint", "entity_name": "string", "entity_type": "string", "sic": "string", "state_of_incorporation": "string", "fiscal_year_end": "string", "ein": "string",
    "description": "string", "category": "string", "last_synced_at": "timestamp", "mdm_entity_id": "string", "parse_sequence": "bigint", "is_tracked": "boolean",
}
FACT_COLUMNS = {
    "cik": "bigint", "accession_number": "string", "concept": "string", "fiscal_year": "int", "fiscal_period": "string", "period_end": "date", "form_type": "string", "segment": "string", "value": "double",
    "unit": "string", "decimals": "int", "is_amended": "boolean", "ingested_at": "timestamp", "mdm_entity_id": "string", "parse_sequence": "bigint",
}
FILE = ["feed_id", "file_seq", "file_id"]


def _scripts(spark: SparkSession, d: str, where: str = "true") -> tuple[DataFrame, DataFrame]:
    records = table(spark, d, "landing_record").where(where)
    values = cut(drift.field_values(records, "payload", FILE))  # parsed once, read by every branch below
    return records, drift.feed_scripts(values, records.select(*FILE))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Changes of the records' own fields; those of nested members are in p2_changes."""
    changes = drift.schema_changes(_scripts(spark, d)[1]).where("level = 1 AND change_kind <> 'moved'")
    return changes.select("file_id", "field_name", "change_kind", "new_name").distinct()


def p2_changes(spark: SparkSession, d: str) -> DataFrame:
    """All changes, those of nested members and moves between levels included."""
    return drift.schema_changes(_scripts(spark, d)[1]).distinct()


def _unified(spark: SparkSession, d: str, name: str, columns: dict[str, str]) -> DataFrame:
    records, scripts = _scripts(spark, d, f"table_name = '{name}'")
    return drift.read_as_one(records, "payload", drift.projections(scripts, list(columns)), columns, ["record_id", "feed_id", "file_seq", "row_no"])


def p2_company_table(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, "sec_company", COMPANY_COLUMNS)


def p2_fact_table(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, "sec_financial_fact", FACT_COLUMNS)


# ---------------------------------------------------------------- a few keys with most records

SKEWED = {"filing_activity": "cik", "ownership_activity": "company_key", "sec_thirteenf_holding": "accession_number"}


def _heavy(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, key in SKEWED.items():
        one = skew.heavy_keys(table(spark, d, name), key).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key_value"), "n_rows", "total_rows")
        out = one if out is None else out.unionByName(one)
    return out


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _heavy(spark, d).select("table_name", "key_value")


def p3_heavy_keys(spark: SparkSession, d: str) -> DataFrame:
    return _heavy(spark, d).withColumn("row_share", F.round(F.col("n_rows") / F.col("total_rows"), 6))


def p3_filings_by_cik(spark: SparkSession, d: str) -> DataFrame:
    """Counts, first and last date and the latest filing of every cik."""
    rows = table(spark, d, "filing_activity").select("cik", "fact_key", "accession_number", "form", "filing_date", "report_date", "is_xbrl")
    latest = F.when(F.col("filing_date").isNotNull(), F.struct("filing_date", "accession_number", "fact_key"))
    out = skew.skew_aggregate(rows, "cik", counts=["form", "report_date"], sums={"n_xbrl": F.when(F.col("is_xbrl"), 1).otherwise(0)}, firsts={"first_filed": F.col("filing_date")}, lasts={"latest": latest})
    return out.select("cik", "n_rows", "n_form", "n_report_date", F.col("n_xbrl").cast("long").alias("n_xbrl"), "first_filed", F.col("latest.filing_date").alias("last_filed"), F.col("latest.accession_number").alias("last_accession"))


def p3_ownership_by_company(spark: SparkSession, d: str) -> DataFrame:
    """Counts and sums of every company's transactions with the date of its latest filing.

    The filing side is reduced to one row per company; heavy companies meet it by broadcast.
    """
    rows = table(spark, d, "ownership_activity").select("company_key", "fact_key", "accession_number", "transaction_shares", "is_derivative")
    filed = table(spark, d, "filing_activity").where(F.col("company_key").isNotNull()).groupBy("company_key").agg(F.max("filing_date").alias("last_filed"), F.count(F.lit(1)).alias("n_filings"))
    heavy = skew.heavy_keys(rows, "company_key")
    joined = skew.skew_join(rows, filed, "company_key", "left", heavy)
    out = skew.skew_aggregate(joined, "company_key", counts=["transaction_shares"], sums={"shares": F.col("transaction_shares").cast("decimal(28,4)"), "n_derivative": F.when(F.col("is_derivative"), 1).otherwise(0)}, lasts={"last_filed": F.col("last_filed"), "n_filings": F.col("n_filings")}, heavy=heavy)
    return out.select("company_key", "n_rows", "n_transaction_shares", F.col("shares").cast("double").alias("shares"), F.col("n_derivative").cast("long").alias("n_derivative"), "last_filed", "n_filings")


def p3_holdings_by_accession(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sec_thirteenf_holding").select("accession_number", "cusip", "market_value", "shares_held", "period_of_report")
    out = skew.skew_aggregate(rows, "accession_number", counts=["cusip"], sums={"market_value": F.col("market_value").cast("decimal(28,4)"), "shares_held": F.col("shares_held").cast("decimal(28,4)")}, lasts={"last_period": F.col("period_of_report")})
    return out.withColumn("market_value", F.col("market_value").cast("double")).withColumn("shares_held", F.col("shares_held").cast("double"))


def p3_latest_transactions(spark: SparkSession, d: str) -> DataFrame:
    """The three latest transactions of every company by date key and fact key."""
    rows = table(spark, d, "ownership_activity").select("company_key", "date_key", "fact_key", "accession_number").distinct()
    order = [F.col("date_key").desc_nulls_last(), F.col("fact_key").desc_nulls_last(), F.col("accession_number").desc_nulls_last()]
    return skew.skew_latest(rows, "company_key", order, 3)


# ---------------------------------------------------------------- differences between two copies

NODE_FIELDS = ["canonical_name", "cik", "ticker", "primary_ticker", "primary_exchange", "parent_company_entity_id"]
EDGE_FIELDS = ["relationship_type", "sourcenodeid", "targetnodeid", "relationship_id", "valid_from_date", "valid_to_date", "date_provenance", "relationship_kind", "source_system", "source_accession"]
EDGE_PROPERTIES = ["pct", "note"]


def _number(c: str | F.Column) -> F.Column:
    """A number's one text however it is written; other text stays."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("decimal(38,10)").cast("string"), c.cast("string"))


def _properties(df: DataFrame, names: list[str]) -> list:
    return [F.try_variant_get("__p", f"$.{n}", "string").alias(n) for n in names]


def _active(spark: SparkSession, d: str, name: str) -> DataFrame:
    pointer = table(spark, d, "graph_active_pointer").select(F.col("active_generation_id").alias("generation_id"))
    return table(spark, d, name).join(F.broadcast(pointer.distinct()), "generation_id", "left_semi")  # a pointer has one row


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    nodes = table(spark, d, "mdm_company").where(F.col("valid_to").isNull()).select("entity_id", "canonical_name", _number("cik").alias("cik"), "ticker", "primary_ticker", "primary_exchange", "parent_company_entity_id", F.lit("company").alias("kind"), F.col("valid_from").alias("at"))
    graph = _active(spark, d, "mdm_graph_nodes").withColumn("__p", F.try_parse_json("properties"))
    graph = graph.select(F.col("nodeid").alias("entity_id"), *_properties(graph, NODE_FIELDS), F.col("entity_type").alias("kind"), F.col("updated_at").alias("at")).withColumn("cik", _number("cik"))
    mdm = table(spark, d, "mdm_relationship_instance").where(F.col("is_active") & ~F.col("quarantined")).withColumn("__p", F.try_parse_json("properties"))
    mdm = mdm.withColumnsRenamed({"rel_type_name": "relationship_type", "source_entity_id": "sourcenodeid", "target_entity_id": "targetnodeid"})
    edges = mdm.select("instance_id", *EDGE_FIELDS, *_properties(mdm, EDGE_PROPERTIES), F.col("updated_at").alias("at")).withColumn("pct", _number("pct"))
    copy = _active(spark, d, "mdm_graph_edges").withColumn("__p", F.try_parse_json("properties"))
    copy = copy.select(F.col("edgeid").alias("instance_id"), *EDGE_FIELDS, *_properties(copy, EDGE_PROPERTIES), F.col("updated_at").alias("at")).withColumn("pct", _number("pct"))
    return nodes, graph, edges, copy


def p4_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every missing object and differing cell with both values."""
    nodes, graph, edges, copy = _sides(spark, d)
    a = diff.table_diff(nodes, graph, "entity_id", NODE_FIELDS, F.col("at"), F.col("at")).withColumn("object_type", F.lit("node"))
    b = diff.table_diff(edges, copy, "instance_id", EDGE_FIELDS + EDGE_PROPERTIES, F.col("at"), F.col("at")).withColumn("object_type", F.lit("edge"))
    sided = F.when(F.col("difference") == "missing_right", "missing_in_graph").when(F.col("difference") == "missing_left", "missing_in_mdm").otherwise(F.col("difference"))
    return a.unionByName(b).select("object_type", "object_key", sided.alias("difference"), "field_name", F.col("left_value").alias("mdm_value"), F.col("right_value").alias("graph_value"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_cells(spark, d).select("object_type", "object_key", "difference", "field_name")


def p4_entity_parity(spark: SparkSession, d: str) -> DataFrame:
    nodes, graph, _, _ = _sides(spark, d)
    return diff.parity(nodes, graph, "entity_id", "kind").select(F.col("kind").alias("entity_type"), F.col("left_count").alias("mdm_active_count"), F.col("right_count").alias("graph_node_count"), F.col("left_minus_right").alias("mdm_minus_graph"), F.col("right_minus_left").alias("graph_minus_mdm"), "status")


def p4_relationship_parity(spark: SparkSession, d: str) -> DataFrame:
    _, _, edges, copy = _sides(spark, d)
    return diff.parity(edges, copy, "instance_id", "relationship_type").select("relationship_type", F.col("left_count").alias("mdm_active_count"), F.col("right_count").alias("graph_edge_count"), F.col("left_minus_right").alias("mdm_minus_graph"), F.col("right_minus_left").alias("graph_minus_mdm"), "status")


def p4_published_parity(spark: SparkSession, d: str) -> DataFrame:
    """Published parity rows of earlier generations, and whether each adds up."""
    out = None
    for name, kind, count in (("graph_review_entity_parity", "entity_type", "graph_node_count"), ("graph_review_relationship_parity", "relationship_type", "graph_edge_count")):
        rows = table(spark, d, name)
        balance = F.col("mdm_active_count") - F.col("mdm_minus_graph") == F.col(count) - F.col("graph_minus_mdm")
        clean = (F.col("mdm_minus_graph") == 0) & (F.col("graph_minus_mdm") == 0)
        one = rows.select(F.lit(name).alias("source_table"), "generation_id", F.col(kind).alias("kind"), balance.alias("counts_add_up"), (F.when(clean, "pass").otherwise("fail") == F.col("status")).alias("status_agrees"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- history

TRACKED = ["entity_name", "sic", "state_of_incorporation", "fiscal_year_end", "category"]


def _history(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sec_company").select("cik", "last_synced_at", "parse_sequence", *TRACKED)
    return history.versions(rows, "cik", "last_synced_at", TRACKED, "parse_sequence", {"entity_name": history.blank_insensitive})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).select("cik", F.unix_seconds("valid_from").alias("version_start")).distinct()


def p5_history(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d)


def p5_names(spark: SparkSession, d: str) -> DataFrame:
    return history.with_former_names(_history(spark, d), table(spark, d, "sec_company_former_name"), "cik", "entity_name")


# ---------------------------------------------------------------- nested records

#: Names of the child tables; other paths that repeat would appear under their keys.
CHILDREN = {
    "owner": ["reportingOwner"],
    "non_derivative": ["reportingOwner", "nonDerivativeTable"],
    "derivative": ["reportingOwner", "derivativeTable"],
    "non_derivative_note": ["reportingOwner", "nonDerivativeTable", "footnotes"],
    "derivative_note": ["reportingOwner", "derivativeTable", "footnotes"],
    "manifest_table": ["tables"],
}
WRAPPERS = ["ownershipDocument", "nonDerivativeTransaction", "derivativeTransaction"]


def _latest(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_payload").select("record_key", "fetched_at", "raw_object_id", "payload")
    return nested.latest_readable(raw, "payload", "record_key", ["fetched_at", "raw_object_id"], WRAPPERS)


def _children(spark: SparkSession, d: str) -> DataFrame:
    return nested.child_rows(_latest(spark, d), "record_key", CHILDREN)


def _at(i: int, name: str) -> F.Column:
    return F.coalesce(F.get("idx", F.lit(i)), F.lit(0)).alias(name)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    rows = nested.child_keys(_latest(spark, d), "record_key", CHILDREN).where(F.col("child_table").isin(*CHILDREN))
    return rows.select("record_key", "child_table", _at(0, "idx1"), _at(1, "idx2"), _at(2, "idx3"))


def p7_child_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many rows every repeated path has, those without a name of their own included."""
    return nested.child_keys(_latest(spark, d), "record_key", CHILDREN).groupBy("child_table").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("record_key").alias("n_records"))


def p7_owners(spark: SparkSession, d: str) -> DataFrame:
    out = nested.child_table(_children(spark, d), "record_key", "owner", {
        "owner_cik": ("reportingOwnerId.rptOwnerCik", "bigint"), "owner_name": ("reportingOwnerId.rptOwnerName", "string"), "is_director": ("reportingOwnerRelationship.isDirector", "boolean"),
        "is_officer": ("reportingOwnerRelationship.isOfficer", "boolean"), "officer_title": ("reportingOwnerRelationship.officerTitle", "string"),
    })
    return out.withColumn("owner_index", _at(0, "owner_index")).drop("idx")


def _both(spark: SparkSession, d: str, plain: str, derivative: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    rows = _children(spark, d)
    one = lambda name, flag: nested.child_table(rows, "record_key", name, columns).withColumn("is_derivative", F.lit(flag))
    return one(plain, False).unionByName(one(derivative, True))


def p7_transactions(spark: SparkSession, d: str) -> DataFrame:
    columns = {
        "security_title": ("securityTitle", "string"), "transaction_date": ("transactionDate", "date"), "transaction_code": ("transactionCoding.transactionCode", "string"),
        "transaction_shares": ("transactionAmounts.transactionShares", "double"), "transaction_price": ("transactionAmounts.transactionPricePerShare", "double"),
        "acquired_disposed": ("transactionAmounts.transactionAcquiredDisposedCode", "string"), "shares_owned_after": ("postTransactionAmounts.sharesOwnedFollowingTransaction", "double"),
        "ownership_nature": ("ownershipNature.directOrIndirectOwnership", "string"), "underlying_title": ("underlyingSecurity.title", "string"), "underlying_shares": ("underlyingSecurity.shares", "double"), "exercise_date": ("exerciseDate", "date"),
    }
    return _both(spark, d, "non_derivative", "derivative", columns).withColumns({"owner_index": _at(0, "owner_index"), "txn_index": _at(1, "txn_index")}).drop("idx")


def p7_footnotes(spark: SparkSession, d: str) -> DataFrame:
    both = _both(spark, d, "non_derivative_note", "derivative_note", {"footnote_id": ("id", "string"), "footnote_text": ("text", "string")})
    return both.withColumns({"owner_index": _at(0, "owner_index"), "txn_index": _at(1, "txn_index"), "footnote_index": _at(2, "footnote_index")}).drop("idx")


def p7_manifest_tables(spark: SparkSession, d: str) -> DataFrame:
    out = nested.child_table(_children(spark, d), "record_key", "manifest_table", {"table_name": ("table_name", "string"), "relative_path": ("relative_path", "string"), "row_count": ("row_count", "bigint"), "file_count": ("file_count", "bigint")})
    return out.withColumn("table_index", _at(0, "table_index")).drop("idx")


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p2_changes, p2_company_table, p2_fact_table,
        p3_found, p3_heavy_keys, p3_filings_by_cik, p3_ownership_by_company, p3_holdings_by_accession, p3_latest_transactions,
        p4_found, p4_cells, p4_entity_parity, p4_relationship_parity, p4_published_parity,
        p5_found, p5_history, p5_names,
        p7_found, p7_child_counts, p7_owners, p7_transactions, p7_footnotes, p7_manifest_tables,
    )
}

_HEAVY = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS n_rows, (SELECT count(*) FROM {t}) AS total_rows FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) >= 0.02 * (SELECT count(*) FROM {t})" for t, k in SKEWED.items()
)
_NUM = "coalesce(CAST(try_cast({0} AS DECIMAL(38,10)) AS VARCHAR), CAST({0} AS VARCHAR))"
_ACTIVE = "generation_id IN (SELECT active_generation_id FROM graph_active_pointer)"
_NODE_SIDES = f"""
    l AS (SELECT DISTINCT entity_id AS k, canonical_name, {_NUM.format("cik")} AS cik, ticker, primary_ticker, primary_exchange, parent_company_entity_id FROM mdm_company WHERE valid_to IS NULL),
    r AS (SELECT DISTINCT nodeid AS k, {", ".join(_NUM.format(f"json_extract_string(properties, '$.{n}')") + f" AS {n}" if n == "cik" else f"json_extract_string(properties, '$.{n}') AS {n}" for n in NODE_FIELDS)} FROM mdm_graph_nodes WHERE {_ACTIVE})"""
_EDGE_SIDES = f"""
    a AS (SELECT DISTINCT instance_id AS k, rel_type_name AS relationship_type, source_entity_id AS sourcenodeid, target_entity_id AS targetnodeid, {", ".join(EDGE_FIELDS[3:])}, {_NUM.format("json_extract_string(properties, '$.pct')")} AS pct, json_extract_string(properties, '$.note') AS note FROM mdm_relationship_instance WHERE is_active AND NOT quarantined),
    b AS (SELECT DISTINCT edgeid AS k, {", ".join(EDGE_FIELDS)}, {_NUM.format("json_extract_string(properties, '$.pct')")} AS pct, json_extract_string(properties, '$.note') AS note FROM mdm_graph_edges WHERE {_ACTIVE})"""


def _cells_sql(kind: str, x: str, y: str, fields: list[str]) -> str:
    parts = [f"SELECT '{kind}' AS object_type, k AS object_key, 'missing_in_graph' AS difference, '' AS field_name, NULL AS mdm_value, NULL AS graph_value FROM {x} WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM {y} WHERE k IS NOT NULL)"]
    parts.append(f"SELECT '{kind}', k, 'missing_in_mdm', '', NULL, NULL FROM {y} WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM {x} WHERE k IS NOT NULL)")
    parts += [f"SELECT '{kind}', {x}.k, 'value', '{f}', CAST({x}.{f} AS VARCHAR), CAST({y}.{f} AS VARCHAR) FROM {x} JOIN {y} ON {x}.k = {y}.k WHERE {x}.{f} IS DISTINCT FROM {y}.{f}" for f in fields]
    return " UNION ALL ".join(parts)


_CELLS_SQL = f"WITH {_NODE_SIDES},{_EDGE_SIDES} {_cells_sql('node', 'l', 'r', NODE_FIELDS)} UNION ALL {_cells_sql('edge', 'a', 'b', EDGE_FIELDS + EDGE_PROPERTIES)}"
_CARRIED = ", ".join(f"last_value({a} IGNORE NULLS) OVER w AS {a}" for a in TRACKED)
_SEEN = f"""
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik, last_synced_at ORDER BY parse_sequence DESC NULLS LAST) AS rn FROM sec_company WHERE cik IS NOT NULL AND last_synced_at IS NOT NULL) WHERE rn = 1),
    held AS (SELECT cik, last_synced_at, {_CARRIED} FROM one WINDOW w AS (PARTITION BY cik ORDER BY last_synced_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    keyed AS (SELECT *, lower(trim(regexp_replace(entity_name, '\\s+', ' ', 'g'))) AS name_key FROM held),
    marked AS (SELECT *, row_number() OVER v AS n, {", ".join(f"lag({c}) OVER v AS p{i}" for i, c in enumerate(["name_key", *TRACKED[1:]]))} FROM keyed WINDOW v AS (PARTITION BY cik ORDER BY last_synced_at)),
    version AS (SELECT cik, last_synced_at AS valid_from, {", ".join(TRACKED)} FROM marked WHERE n = 1 OR {" OR ".join(f"{c} IS DISTINCT FROM p{i}" for i, c in enumerate(["name_key", *TRACKED[1:]]))})"""

_UNITS = "CASE WHEN {0} IS NULL OR json_type({0}) = 'NULL' THEN NULL WHEN json_type({0}) = 'ARRAY' THEN {0} ELSE json_array({0}) END"
_READABLE = """
    texts AS (SELECT record_key, fetched_at, raw_object_id, CASE WHEN json_valid(payload) AND json_type(payload) = 'VARCHAR' THEN json_extract_string(payload, '$') ELSE payload END AS j FROM raw_payload WHERE record_key IS NOT NULL),
    last AS (SELECT record_key, arg_max(j, (fetched_at, raw_object_id)) AS j FROM texts WHERE json_valid(j) GROUP BY 1)"""

SQL = {
    "p3_found": f"SELECT table_name, key_value FROM ({_HEAVY})",
    "p3_heavy_keys": f"SELECT *, round(n_rows / total_rows, 6) AS row_share FROM ({_HEAVY})",
    "p3_filings_by_cik": """
        SELECT cik, count(*) AS n_rows, count(form) AS n_form, count(report_date) AS n_report_date, CAST(count(*) FILTER (WHERE is_xbrl) AS BIGINT) AS n_xbrl, min(filing_date) AS first_filed,
               max(filing_date) AS last_filed, max(accession_number) FILTER (WHERE filing_date = top) AS last_accession
        FROM (SELECT *, max(filing_date) OVER (PARTITION BY cik) AS top FROM filing_activity) GROUP BY cik""",
    "p3_ownership_by_company": """
        SELECT o.company_key, count(*) AS n_rows, count(transaction_shares) AS n_transaction_shares, CAST(sum(CAST(transaction_shares AS DECIMAL(28,4))) AS DOUBLE) AS shares,
               CAST(count(*) FILTER (WHERE is_derivative) AS BIGINT) AS n_derivative, max(f.last_filed) AS last_filed, max(f.n_filings) AS n_filings
        FROM ownership_activity o LEFT JOIN (SELECT company_key, max(filing_date) AS last_filed, count(*) AS n_filings FROM filing_activity GROUP BY 1) f ON o.company_key = f.company_key GROUP BY o.company_key""",
    "p3_holdings_by_accession": """
        SELECT accession_number, count(*) AS n_rows, count(cusip) AS n_cusip, CAST(sum(CAST(market_value AS DECIMAL(28,4))) AS DOUBLE) AS market_value,
               CAST(sum(CAST(shares_held AS DECIMAL(28,4))) AS DOUBLE) AS shares_held, max(period_of_report) AS last_period FROM sec_thirteenf_holding GROUP BY accession_number""",
    "p3_latest_transactions": """
        SELECT company_key, date_key, fact_key, accession_number FROM (
            SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY date_key DESC NULLS LAST, fact_key DESC NULLS LAST, accession_number DESC NULLS LAST) AS rn
            FROM (SELECT DISTINCT company_key, date_key, fact_key, accession_number FROM ownership_activity)) WHERE rn <= 3""",
    "p4_found": f"SELECT object_type, object_key, difference, field_name FROM ({_CELLS_SQL})",
    "p4_cells": _CELLS_SQL,
    "p4_entity_parity": f"""
        WITH l AS (SELECT DISTINCT 'company' AS kind, entity_id AS k FROM mdm_company WHERE valid_to IS NULL), r AS (SELECT DISTINCT entity_type AS kind, nodeid AS k FROM mdm_graph_nodes WHERE {_ACTIVE}),
        j AS (SELECT coalesce(l.kind, r.kind) AS kind, l.k AS a, r.k AS b FROM l FULL JOIN r ON l.k = r.k AND l.kind = r.kind)
        SELECT kind AS entity_type, count(a) AS mdm_active_count, count(b) AS graph_node_count, count(*) FILTER (WHERE b IS NULL) AS mdm_minus_graph, count(*) FILTER (WHERE a IS NULL) AS graph_minus_mdm,
               CASE WHEN count(a) = count(*) AND count(b) = count(*) THEN 'pass' ELSE 'fail' END AS status FROM j GROUP BY kind""",
    "p4_relationship_parity": f"""
        WITH l AS (SELECT DISTINCT rel_type_name AS kind, instance_id AS k FROM mdm_relationship_instance WHERE is_active AND NOT quarantined), r AS (SELECT DISTINCT relationship_type AS kind, edgeid AS k FROM mdm_graph_edges WHERE {_ACTIVE}),
        j AS (SELECT coalesce(l.kind, r.kind) AS kind, l.k AS a, r.k AS b FROM l FULL JOIN r ON l.k = r.k AND l.kind = r.kind)
        SELECT kind AS relationship_type, count(a) AS mdm_active_count, count(b) AS graph_edge_count, count(*) FILTER (WHERE b IS NULL) AS mdm_minus_graph, count(*) FILTER (WHERE a IS NULL) AS graph_minus_mdm,
               CASE WHEN count(a) = count(*) AND count(b) = count(*) THEN 'pass' ELSE 'fail' END AS status FROM j GROUP BY kind""",
    "p4_published_parity": " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, generation_id, {k} AS kind, mdm_active_count - mdm_minus_graph = {n} - graph_minus_mdm AS counts_add_up, (CASE WHEN mdm_minus_graph = 0 AND graph_minus_mdm = 0 THEN 'pass' ELSE 'fail' END) = status AS status_agrees FROM {t}"
        for t, k, n in (("graph_review_entity_parity", "entity_type", "graph_node_count"), ("graph_review_relationship_parity", "relationship_type", "graph_edge_count"))
    ),
    "p5_found": f"WITH {_SEEN} SELECT DISTINCT cik, CAST(floor(epoch(valid_from)) AS BIGINT) AS version_start FROM version",
    "p5_history": f"WITH {_SEEN} SELECT cik, valid_from, lead(valid_from) OVER (PARTITION BY cik ORDER BY valid_from) AS valid_to, lead(valid_from) OVER (PARTITION BY cik ORDER BY valid_from) IS NULL AS is_current, {', '.join(TRACKED)} FROM version",
    "p7_manifest_tables": f"""
        WITH {_READABLE}, u AS (SELECT record_key, {_UNITS.format("json_extract(j, '$.tables')")} AS a FROM last), e AS (SELECT record_key, unnest(CAST(a AS JSON[])) AS t, generate_subscripts(CAST(a AS JSON[]), 1) AS i FROM u WHERE a IS NOT NULL)
        SELECT record_key, CAST(i AS INT) AS table_index, json_extract_string(t, '$.table_name') AS table_name, json_extract_string(t, '$.relative_path') AS relative_path, try_cast(json_extract_string(t, '$.row_count') AS BIGINT) AS row_count, try_cast(json_extract_string(t, '$.file_count') AS BIGINT) AS file_count
        FROM e WHERE json_type(t) <> 'NULL' AND CAST(t AS VARCHAR) NOT IN ('{{}}', '[]')""",
    "p5_names": None,
}
SQL = {k: v for k, v in SQL.items() if v}
