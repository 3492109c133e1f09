"""Queries of statements: picking concepts, derived metrics, factor packs, forensic scores, calendars, compensation, revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.functions import finance as fin
from cairnflow.functions import text as T
from cairnflow.operators import calendar as cal
from cairnflow.operators import finance as fo
from cairnflow.plans.registry import Query, registrar
from cairnflow.session import table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

# ---------------------------------------------------------------- facts and statements

CONCEPTS = ["Revenues", "SalesRevenueNet", "GrossProfit", "NetIncomeLoss"]
CHOICES = {"revenue": ["Revenues", "SalesRevenueNet"], "gross_profit": ["GrossProfit"], "net_income": ["NetIncomeLoss", "ProfitLoss"]}
_FACTS = f"SELECT l_orderkey AS accession, {CONCEPTS}[1 + (l_linenumber + l_suppkey) % 4] AS concept, CASE WHEN l_partkey % 9 > 0 THEN l_extendedprice END AS value, CAST(l_shipdate AS DATE) AS period_start FROM lineitem"
_BEST = "arg_max(value, (period_start, -value)) FILTER (WHERE concept = '{}' AND value IS NOT NULL)"


@query(f"WITH f AS ({_FACTS}) SELECT accession, coalesce({_BEST.format('Revenues')}, {_BEST.format('SalesRevenueNet')}) AS revenue, {_BEST.format('GrossProfit')} AS gross_profit, {_BEST.format('NetIncomeLoss')} AS net_income FROM f WHERE value IS NOT NULL GROUP BY 1")
def dm_concepts(spark, d):
    """The first known concept of each preference list, by its latest period start."""
    l = table(spark, d, "lineitem")
    name = F.get(F.array(*map(F.lit, CONCEPTS)), ((F.col("l_linenumber") + F.col("l_suppkey")) % 4).cast("int"))
    facts = l.select(F.col("l_orderkey").alias("accession"), name.alias("concept"), F.when(F.col("l_partkey") % 9 > 0, F.col("l_extendedprice")).alias("value"), F.to_date("l_shipdate").alias("period_start"))
    return fo.pick_concepts(facts, ["accession"], "concept", "value", "period_start", CHOICES)


_SUMS = "SELECT l_suppkey AS cik, year(l_shipdate)::INT AS y, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS p, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS q, sum(CAST(l_discount * 1000 AS DECIMAL(18,2)))::DOUBLE AS d, sum(CAST(l_tax * 1000 AS DECIMAL(18,2)))::DOUBLE AS t, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2"
#: Statement items as expressions over a supplier's yearly sums that both engines read; gaps and zeros are part of it.
ITEMS = {
    "revenue": "CASE WHEN (cik + y) % 11 > 0 THEN p END", "gross_profit": "p * 0.4 - d * 100", "ebit": "p * 0.1 - t * 50", "depreciation": "CASE WHEN cik % 8 > 0 THEN q * 3 END", "net_income": "p * 0.05 - t * 50 - d * 10", "operating_cash": "p * 0.04 + q - (cik % 5) * 1000", "capex": "CASE WHEN cik % 6 > 0 THEN -q * 2 END",
    "assets": "CASE WHEN (cik + y) % 13 = 0 THEN NULL WHEN (cik + y) % 17 = 0 THEN 0 ELSE p * 1.5 + q END", "liabilities": "p * 0.7 + d * 100", "equity": "p * 0.8 + q - d * 900", "cash": "q * 10", "long_debt": "CASE WHEN cik % 3 > 0 THEN d * 100 END", "short_debt": "CASE WHEN cik % 4 > 0 THEN t * 50 END", "retained": "p * 0.2 - d * 300",
    "current_assets": "p * 0.5", "current_liabilities": "CASE WHEN cik % 9 > 0 THEN p * 0.3 + d END", "receivables": "p * 0.1 + t", "inventory": "p * 0.15", "sga": "p * 0.08 + q", "ppe": "p * 0.6 - q", "shares": "n * 1000 + cik",
}
#: A year is reported by its own filing and, restated, by the next year's.
_STATED = f"SELECT cik, cik * 10000 + y + k AS accession_number, y AS fiscal_year, 'FY' AS fiscal_period, make_date(y, 12, 31) AS period_end, {', '.join(f'({e}) * CASE WHEN k = 1 THEN 1.25 ELSE 1 END AS {n}' for n, e in ITEMS.items())} FROM ({_SUMS}) s, (SELECT unnest([0, 1]) AS k) r WHERE (cik + y) % 19 > 0"
_DERIVED = f"SELECT * FROM (SELECT *, ebit + depreciation AS ebitda, CASE WHEN long_debt IS NOT NULL OR short_debt IS NOT NULL THEN coalesce(long_debt, 0) + coalesce(short_debt, 0) END AS total_debt, operating_cash - abs(capex) AS free_cash_flow FROM ({_STATED})) WHERE coalesce(revenue, gross_profit, ebitda, net_income, assets) IS NOT NULL"
_R = lambda n, d: f"CASE WHEN ({d}) <> 0 THEN ({n}) / ({d}) END"


def stated(spark: SparkSession, d: str) -> DataFrame:
    """Yearly statements of suppliers with every item that the metrics need, made of line items."""
    dec = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")
    l = table(spark, d, "lineitem")
    sums = l.groupBy(F.col("l_suppkey").alias("cik"), F.year("l_shipdate").alias("y")).agg(dec(F.col("l_extendedprice")).alias("p"), dec(F.col("l_quantity")).alias("q"), dec(F.col("l_discount") * 1000).alias("d"), dec(F.col("l_tax") * 1000).alias("t"), F.count(F.lit(1)).cast("double").alias("n"))
    sums = sums.where("(cik + y) % 19 > 0").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    scale = F.when(F.col("k") == 1, 1.25).otherwise(1.0)
    return sums.select("cik", (F.col("cik") * 10000 + F.col("y") + F.col("k")).alias("accession_number"), F.col("y").alias("fiscal_year"), F.lit("FY").alias("fiscal_period"), F.make_date("y", F.lit(12), F.lit(31)).alias("period_end"), *((F.expr(e).cast("double") * scale).alias(n) for n, e in ITEMS.items()))


def derived(spark: SparkSession, d: str) -> DataFrame:
    return fo.derived_metrics(stated(spark, d))


@query(f"SELECT cik, accession_number, fiscal_year, round(ebitda, 4) AS ebitda, round(total_debt, 4) AS total_debt, round(free_cash_flow, 4) AS free_cash_flow, round({_R('gross_profit', 'revenue')}, 8) AS gross_margin, round({_R('ebitda', 'revenue')}, 8) AS ebitda_margin, round({_R('net_income', 'assets')}, 8) AS roa, round({_R('net_income', 'equity')}, 8) AS roe, round({_R('ebit', 'equity + total_debt')}, 8) AS roic FROM ({_DERIVED})")
def dm_derived(spark, d):
    r = lambda c, n: F.round(c, n).alias(c)
    return derived(spark, d).select("cik", "accession_number", "fiscal_year", *(r(c, 4) for c in ("ebitda", "total_debt", "free_cash_flow")), *(r(c, 8) for c in ("gross_margin", "ebitda_margin", "roa", "roe", "roic")))


_CURRENT = f"SELECT *, period_end = max(period_end) OVER (PARTITION BY cik, accession_number, fiscal_period) AS is_current_period FROM ({_DERIVED})"
_YEAR = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik, fiscal_year ORDER BY is_current_period DESC, accession_number DESC) AS r FROM b WHERE fiscal_period = 'FY') WHERE r = 1"


@query(f"WITH b AS ({_CURRENT}), v AS ({_YEAR}) SELECT b.cik, b.accession_number, b.fiscal_year, b.is_current_period, round({_R('b.revenue - p.revenue', 'p.revenue')}, 8) AS revenue_growth, round({_R('b.ebitda - p.ebitda', 'p.ebitda')}, 8) AS ebitda_growth, round({_R('b.net_income - p.net_income', 'p.net_income')}, 8) AS net_income_growth FROM b LEFT JOIN v p ON p.cik = b.cik AND p.fiscal_period = b.fiscal_period AND p.fiscal_year = b.fiscal_year - 1")
def dm_yearly_growth(spark, d):
    """Growth against the canonical row of the year before: the filing's own current period first, then the greatest accession."""
    b = fo.with_current(derived(spark, d))
    v = fo.canonical_year(b, "cik", "fiscal_year", "is_current_period", "accession_number")
    past = v.select("cik", "fiscal_period", (F.col("fiscal_year") + 1).alias("fiscal_year"), *(F.col(c).alias(f"{c}__1") for c in ("revenue", "ebitda", "net_income")))
    j = b.join(past, ["cik", "fiscal_period", "fiscal_year"], "left")
    return j.select("cik", "accession_number", "fiscal_year", "is_current_period", *(F.round(fin.growth(F.col(c), F.col(f"{c}__1")), 8).alias(f"{c}_growth") for c in ("revenue", "ebitda", "net_income")))


_PACK = [n for n, _, _ in fo.FACTORS]
_CAGR = lambda c, n: f"CASE WHEN b.{c} > 0 AND p{n}.{c} > 0 THEN pow(b.{c} / p{n}.{c}, 1.0 / {n}) - 1 END"


@query(f"""WITH b AS ({_CURRENT}), v AS ({_YEAR}), f AS (SELECT *, {', '.join(f'{_R(n, m)} AS f_{name}' for name, n, m in fo.FACTORS)} FROM b) SELECT b.cik, b.accession_number, b.fiscal_year, {', '.join(f'round(b.f_{n}, 8) AS {n}' for n in _PACK)}, round(CASE WHEN b.equity > 0 THEN b.net_income / b.equity END, 8) AS return_on_equity, round({_R('b.assets - p1.assets', 'p1.assets')}, 8) AS asset_growth_yoy, round(b.shares - p1.shares, 4) AS shares_yoy_change,
{', '.join(f'round({_CAGR(c, n)}, 8) AS {c}_cagr_{n}y' for c in ('revenue', 'net_income', 'assets') for n in (3, 5))} FROM f b LEFT JOIN v p1 ON p1.cik = b.cik AND p1.fiscal_year = b.fiscal_year - 1 LEFT JOIN v p3 ON p3.cik = b.cik AND p3.fiscal_year = b.fiscal_year - 3 LEFT JOIN v p5 ON p5.cik = b.cik AND p5.fiscal_year = b.fiscal_year - 5""")
def dm_factor_pack(spark, d):
    f = fo.factor_pack(derived(spark, d))
    names = [*_PACK, "return_on_equity", "asset_growth_yoy", *(f"{c}_cagr_{n}y" for c in ("revenue", "net_income", "assets") for n in (3, 5))]
    return f.select("cik", "accession_number", "fiscal_year", *(F.round(n, 8).alias(n) for n in names), F.round("shares_yoy_change", 4).alias("shares_yoy_change"))


_P = lambda e: e.replace("x.", "p.")
_QUALITY, _WEAR = f"(1 - {_R('x.current_assets + x.ppe', 'x.assets')})", _R("x.depreciation", "x.depreciation + x.ppe")
_M = {
    "dsri": _R(_R("x.receivables", "x.revenue"), _P(_R("x.receivables", "x.revenue"))), "gmi": _R(_P(_R("x.gross_profit", "x.revenue")), _R("x.gross_profit", "x.revenue")), "aqi": _R(_QUALITY, _P(_QUALITY)), "sgi": _R("x.revenue", "p.revenue"), "depi": _R(_P(_WEAR), _WEAR),
    "sgai": _R(_R("x.sga", "x.revenue"), _P(_R("x.sga", "x.revenue"))), "lvgi": _R(_R("x.total_debt", "x.assets"), _P(_R("x.total_debt", "x.assets"))), "tata": _R("x.net_income - x.operating_cash", "x.assets"),
}
_MW = {"dsri": 0.920, "gmi": 0.528, "aqi": 0.404, "sgi": 0.892, "depi": 0.115, "sgai": -0.172, "lvgi": -0.327, "tata": 4.679}
_Z = [(1.2, _R("x.current_assets - x.current_liabilities", "x.assets")), (1.4, _R("x.retained", "x.assets")), (3.3, _R("x.ebit", "x.assets")), (0.6, _R("x.equity", "x.liabilities")), (1.0, _R("x.revenue", "x.assets"))]
_GT = lambda n, d, op=">": f"({_R(f'x.{n}', f'x.{d}')}) {op} ({_R(f'p.{n}', f'p.{d}')})"
_F = [f"({_R('x.net_income', 'x.assets')}) > 0", "x.operating_cash > 0", _GT("net_income", "assets"), "x.operating_cash > x.net_income", _GT("total_debt", "assets", "<"), _GT("current_assets", "current_liabilities"), "x.shares <= p.shares", _GT("gross_profit", "revenue"), _GT("revenue", "assets")]
_SUM = lambda parts: " + ".join(parts)


@query(f"""WITH b AS ({_CURRENT}), v AS ({_YEAR}), o AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY fiscal_year) AS i FROM v), s AS (SELECT x.cik, x.fiscal_year, p.cik IS NOT NULL AS has, x.assets AS ta, {', '.join(f'{e} AS {k}' for k, e in _M.items())}, {', '.join(f'{e} AS z{i}' for i, (_, e) in enumerate(_Z))}, {', '.join(f'{e} AS f{i}' for i, e in enumerate(_F))} FROM o x LEFT JOIN o p ON p.cik = x.cik AND p.i = x.i - 1)
SELECT cik, fiscal_year, round(CASE WHEN has AND {_SUM(f'({k} IS NOT NULL)::INT' for k in _M)} >= 2 THEN -4.84 + {_SUM(f'coalesce({w} * {k}, 0)' for k, w in _MW.items())} END, 3) AS m, round(CASE WHEN ta <> 0 AND {_SUM(f'(z{i} IS NOT NULL)::INT' for i in range(5))} >= 2 THEN {_SUM(f'coalesce({w} * z{i}, 0)' for i, (w, _) in enumerate(_Z))} END, 3) AS z, CASE WHEN coalesce({', '.join(f'f{i}' for i in range(9))}) IS NOT NULL THEN {_SUM(f'coalesce(f{i}::INT, 0)' for i in range(9))} END AS f FROM s""")
def dm_forensics(spark, d):
    """All eight, five and nine terms of the three scores over whole years, each against the filed year before."""
    v = fo.canonical_year(fo.with_current(derived(spark, d)), "cik", "fiscal_year", "is_current_period", "accession_number")
    s = fo.forensic_scores(v.drop("is_current_period"), digits=12)
    return s.select("cik", "fiscal_year", F.round("m", 3).alias("m"), F.round("z", 3).alias("z"), "f")


# ---------------------------------------------------------------- compensation, calendars, releases

_PAY = "SELECT o_custkey AS cik, year(o_orderdate)::INT AS fiscal_year, o_custkey * 10000 + year(o_orderdate) AS accession_number, o_orderpriority AS exec_name, max(CASE WHEN o_orderkey % 10 > 0 THEN o_totalprice END) AS total_comp FROM orders GROUP BY 1, 2, 3, 4"


@query(f"WITH e AS ({_PAY}), l AS (SELECT *, lag(total_comp) OVER (PARTITION BY cik, exec_name ORDER BY fiscal_year) AS was FROM e) SELECT cik, fiscal_year, exec_name, rank() OVER (PARTITION BY cik, accession_number ORDER BY coalesce(total_comp, 0) DESC) AS comp_rank, round({_R('total_comp - was', 'was')}, 8) AS comp_change, row_number() OVER (PARTITION BY cik, exec_name ORDER BY fiscal_year DESC) = 1 AS is_current_role FROM l")
def dm_executives(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("fiscal_year"), F.col("o_orderpriority").alias("exec_name")).agg(F.max(F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice"))).alias("total_comp"))
    e = fo.compensation(o.withColumn("accession_number", F.col("cik") * 10000 + F.col("fiscal_year")), "cik", "accession_number", "exec_name", "exec_name", "fiscal_year", "total_comp")
    return e.select("cik", "fiscal_year", "exec_name", "comp_rank", F.round("comp_change", 8).alias("comp_change"), "is_current_role")


_CALENDAR = "SELECT o_custkey AS cik, year(o_orderdate)::INT AS fiscal_year, quarter(o_orderdate)::INT AS fiscal_quarter, CAST(max(o_orderdate) AS DATE) AS expected_date, CASE max(o_orderkey) % 4 WHEN 0 THEN 'reported' WHEN 1 THEN 'cancelled' WHEN 2 THEN 'confirmed' ELSE 'estimated' END AS status, CASE max(o_orderkey) % 3 WHEN 0 THEN 'pre' WHEN 1 THEN 'post' ELSE 'unknown' END AS session FROM orders GROUP BY 1, 2, 3"
_RELEASES = "SELECT o_custkey AS cik, year(o_orderdate)::INT AS fiscal_year, quarter(o_orderdate)::INT AS fiscal_quarter, max(o_orderkey) AS accession FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2, 3"


def _calendar(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("fiscal_quarter")).agg(F.to_date(F.max("o_orderdate")).alias("expected_date"), F.max("o_orderkey").alias("k"))
    status = F.when(F.col("k") % 4 == 0, "reported").when(F.col("k") % 4 == 1, "cancelled").when(F.col("k") % 4 == 2, "confirmed").otherwise("estimated")
    return o.select("cik", "fiscal_year", "fiscal_quarter", "expected_date", status.alias("status"), F.when(F.col("k") % 3 == 0, "pre").when(F.col("k") % 3 == 1, "post").otherwise("unknown").alias("session"))


@query(f"SELECT c.cik, c.fiscal_year, c.fiscal_quarter, CASE WHEN r.cik IS NOT NULL AND status NOT IN ('reported', 'cancelled') THEN 'reported' ELSE status END AS status, CASE WHEN r.cik IS NOT NULL AND status NOT IN ('reported', 'cancelled') THEN r.accession END AS accession, CASE WHEN r.cik IS NOT NULL AND status NOT IN ('reported', 'cancelled') THEN DATE '2024-01-01' ELSE DATE '2023-01-01' END AS as_of FROM ({_CALENDAR}) c LEFT JOIN ({_RELEASES}) r USING (cik, fiscal_year, fiscal_quarter)")
def dm_mark_reported(spark, d):
    """Expected dates whose release has come are reported in a new revision; reported and cancelled ones stay."""
    r = table(spark, d, "orders").where("o_orderkey % 2 = 0").groupBy(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("fiscal_quarter")).agg(F.max("o_orderkey").alias("accession"))
    c = _calendar(spark, d).withColumn("as_of", F.lit("2023-01-01").cast("date"))
    return cal.mark_reported(c, r, ["cik", "fiscal_year", "fiscal_quarter"], "accession", "2024-01-01").select("cik", "fiscal_year", "fiscal_quarter", "status", "accession", "as_of")


@query(f"SELECT cik, fiscal_year, fiscal_quarter, expected_date, session FROM ({_CALENDAR}) WHERE status IN ('estimated', 'confirmed') AND expected_date BETWEEN DATE '1996-03-01' AND DATE '1996-03-01' + 90")
def dm_next_days(spark, d):
    """What is expected within ninety days of a day."""
    return cal.next_days(_calendar(spark, d), "1996-03-01", 90).select("cik", "fiscal_year", "fiscal_quarter", "expected_date", "session")


@query(f"WITH u AS (SELECT DISTINCT c_custkey AS cik FROM customer), c AS (SELECT u.cik, coalesce(bool_or(status = 'reported' OR status IN ('estimated', 'confirmed') AND expected_date >= DATE '2000-01-01'), false) AS ok FROM u LEFT JOIN ({_CALENDAR}) k ON k.cik = u.cik GROUP BY 1) SELECT count(*) AS universe_size, count(*) FILTER (WHERE ok) AS covered, round(count(*) FILTER (WHERE ok) / count(*), 9) AS coverage_rate, CASE WHEN count(*) >= 10 THEN count(*) FILTER (WHERE ok) / count(*) >= 0.80 END AS meets FROM c")
def dm_calendar_coverage(spark, d):
    c = cal.coverage(_calendar(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("cik")), "cik", "2000-01-01")
    return c.withColumn("coverage_rate", F.round("coverage_rate", 9))


_HOL = "DATE '2023-01-02', DATE '2023-01-16', DATE '2023-02-20', DATE '2023-05-29', DATE '2023-06-19', DATE '2023-07-04', DATE '2023-09-04', DATE '2023-10-09', DATE '2023-11-10', DATE '2023-11-23', DATE '2023-12-25', DATE '2022-12-26', DATE '2022-11-24', DATE '2022-11-11', DATE '2024-01-01', DATE '2024-01-15'"


@query(f"""WITH s AS (SELECT CAST(day AS DATE) AS day FROM range(DATE '2023-01-01', DATE '2023-12-30', INTERVAL 1 DAY) t(day)), b AS (SELECT CAST(day AS DATE) AS b FROM range(DATE '2022-12-01', DATE '2024-01-31', INTERVAL 1 DAY) t(day) WHERE isodow(day) < 6 AND CAST(day AS DATE) NOT IN ({_HOL})) SELECT day, (SELECT max(b) FROM b WHERE b < day) AS previous_day, (SELECT min(b) FROM b WHERE b > day) AS next_day, (SELECT min(b) FROM b WHERE b > day) + INTERVAL 1 HOUR * CASE WHEN (SELECT min(b) FROM b WHERE b > day) BETWEEN DATE '2023-03-12' AND DATE '2023-11-04' THEN 10 ELSE 11 END AS available_at FROM s""")
def fn_calendar_days(spark, d):
    """The business day before and after every day, and six in the morning of the latter in New York, as UTC."""
    from cairnflow.operators import relational as R

    return cal.business_days(R.date_spine(spark, "2023-01-01", "2023-12-29").select("day"), "day", R.federal_holidays(spark, 2022, 2024))


@query("SELECT event_id, CASE lower(trim(s)) WHEN 'bmo' THEN 'pre' WHEN 'before market open' THEN 'pre' WHEN 'pre' THEN 'pre' WHEN 'amc' THEN 'post' WHEN 'after market close' THEN 'post' WHEN 'post' THEN 'post' ELSE 'unknown' END AS session FROM (SELECT event_id, ['BMO', ' before market open', 'amc', 'After Market Close', 'Post', 'noon', NULL][1 + event_id % 7] AS s FROM events)")
def fn_sessions(spark, d):
    s = F.get(F.array(*(F.lit(x) for x in ("BMO", " before market open", "amc", "After Market Close", "Post", "noon", None))), (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", cal.session_of(s).alias("session"))


@query("SELECT event_id, CASE WHEN fp IN ('Q1', 'Q2', 'Q3', 'Q4') THEN CAST(fp[2] AS INT) END AS quarter, quarter(ts)::INT AS by_date FROM (SELECT *, ['Q1', 'q2', 'FY', NULL, 'Q5', 'Q4'][1 + event_id % 6] AS f, upper(['Q1', 'q2', 'FY', NULL, 'Q5', 'Q4'][1 + event_id % 6]) AS fp FROM events)")
def fn_quarters(spark, d):
    f = F.get(F.array(*(F.lit(x) for x in ("Q1", "q2", "FY", None, "Q5", "Q4"))), (F.col("event_id") % 6).cast("int"))
    return table(spark, d, "events").select("event_id", T.quarter_of(f).alias("quarter"), F.quarter("ts").alias("by_date"))
