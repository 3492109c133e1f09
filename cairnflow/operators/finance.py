"""Statement arithmetic: picking concepts, derived metrics, growth, factor packs and forensic scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions import finance as fin
from cairnflow.operators.relational import shifted, top_per_group


def pick_concepts(facts: DataFrame, group: Sequence[str], concept: str, value: str, start: str, choices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per group one column per result: the first known concept of its preference list, each by its latest period start.

    Of several facts with one start the least value stands; NULL values count as unknown. One aggregation, no join.
    """
    known = facts.where(F.col(value).isNotNull())
    wanted = list(dict.fromkeys(c for cs in choices.values() for c in cs))
    best = [F.max(F.when(F.col(concept) == c, F.struct(F.coalesce(F.col(start).cast("string"), F.lit("")).alias("s"), (-F.col(value)).alias("v")))).alias(f"__{i}") for i, c in enumerate(wanted)]
    picked = known.groupBy(*group).agg(*best)
    at = {c: -F.col(f"__{i}.v") for i, c in enumerate(wanted)}
    return picked.select(*group, *(F.coalesce(*(at[c] for c in cs)).alias(name) for name, cs in choices.items()))


def derived_metrics(df: DataFrame) -> DataFrame:
    """Adds ebitda, total_debt, free_cash_flow, margins and returns to picked concepts; rows without any headline value are left out.

    ebitda and free cash flow need both of their parts, debt either; roic is over equity and debt, both known.
    """
    c = F.col
    debt = F.when(c("long_debt").isNotNull() | c("short_debt").isNotNull(), F.coalesce("long_debt", F.lit(0.0)) + F.coalesce("short_debt", F.lit(0.0)))
    out = df.withColumns({"ebitda": c("ebit") + c("depreciation"), "total_debt": debt, "free_cash_flow": c("operating_cash") - F.abs("capex")})
    ratios = {"gross_margin": ("gross_profit", "revenue"), "ebitda_margin": ("ebitda", "revenue"), "net_margin": ("net_income", "revenue"), "roa": ("net_income", "assets"), "roe": ("net_income", "equity")}
    out = out.withColumns({name: fin.safe_ratio(c(n), c(d)) for name, (n, d) in ratios.items()} | {"roic": fin.safe_ratio(c("ebit"), c("equity") + c("total_debt"))})
    return out.where(F.coalesce("revenue", "gross_profit", "ebitda", "net_income", "assets").isNotNull())


#: Ratios of the factor pack: name, numerator, denominator (fixed values); numerators may be differences.
FACTORS = [
    ("working_capital_to_assets", "current_assets - current_liabilities", "assets"), ("current_ratio", "current_assets", "current_liabilities"), ("quick_ratio", "current_assets - inventory", "current_liabilities"),
    ("receivables_to_revenue", "receivables", "revenue"), ("inventory_to_assets", "inventory", "assets"), ("sga_to_revenue", "sga", "revenue"), ("retained_earnings_to_assets", "retained", "assets"), ("asset_turnover", "revenue", "assets"),
    ("debt_to_assets", "total_debt", "assets"), ("cash_to_assets", "cash", "assets"), ("free_cash_flow_to_revenue", "free_cash_flow", "revenue"), ("accruals_to_assets", "net_income - operating_cash", "assets"),
    ("gross_margin", "gross_profit", "revenue"), ("operating_margin", "ebit", "revenue"), ("net_margin", "net_income", "revenue"), ("return_on_assets", "net_income", "assets"),
]


def with_current(df: DataFrame, key: str = "cik", accession: str = "accession_number", period: str = "fiscal_period", end: str = "period_end") -> DataFrame:
    """Adds is_current_period: the row is of the latest period that its filing reports."""
    return df.withColumn("is_current_period", F.col(end) == F.max(end).over(Window.partitionBy(key, accession, period)))


def factor_pack(df: DataFrame, key: str = "cik", year: str = "fiscal_year", period: str = "fiscal_period", accession: str = "accession_number") -> DataFrame:
    """Adds to derived metrics the ratios of FACTORS, return on positive equity, and for whole years the growth of assets and shares and the 3 and 5 year growth rates.

    Earlier years come from one row each: the filing's own current period first, then the greatest accession; a missing year gives NULL.
    """
    base = with_current(df, key, accession, period)
    past = ["assets", "shares", "revenue", "net_income"]
    years = canonical_year(base.where(F.col(period) == "FY"), key, year, "is_current_period", accession).select(key, year, *past)
    out = base
    for n in (1, 3, 5):
        out = out.join(years.select(key, (F.col(year) + n).alias(year), *(F.col(c).alias(f"__{c}_{n}") for c in past)), [key, year], "left")
    full = F.col(period) == "FY"
    then = lambda c, n: F.col(f"__{c}_{n}")
    made = {name: fin.safe_ratio(F.expr(n), F.col(d)) for name, n, d in FACTORS} | {"return_on_equity": fin.safe_ratio_signed(F.col("net_income"), F.col("equity"))}
    made |= {"asset_growth_yoy": F.when(full, fin.growth(F.col("assets"), then("assets", 1))), "shares_yoy_change": F.when(full, F.col("shares") - then("shares", 1))}
    made |= {f"{c}_cagr_{n}y": F.when(full, fin.cagr(F.col(c), then(c, n), n)) for c in ("revenue", "net_income", "assets") for n in (3, 5)}
    return out.withColumns(made).drop(*(f"__{c}_{n}" for c in past for n in (1, 3, 5)))


def forensic_scores(df: DataFrame, key: str = "cik", year: str = "fiscal_year", digits: int = 4) -> DataFrame:
    """(key, year, m, z, f): the three scores of whole years, one row per key and year, against the row before it whatever the gap.

    The first year has no m; signals that need the year before don't count in its f.
    """
    b = with_previous(df, key, year)
    c, p = F.col, lambda n: F.col(f"prev.{n}")
    r = fin.safe_ratio
    both = lambda f: (f(c), f(p))
    quality = lambda g: 1 - r(g("current_assets") + g("ppe"), g("assets"))
    wear = lambda g: r(g("depreciation"), g("depreciation") + g("ppe"))
    margin = lambda g: r(g("gross_profit"), g("revenue"))
    part = lambda n, d: lambda g: r(g(n), g(d))
    now_before = {"dsri": part("receivables", "revenue"), "aqi": quality, "sgai": part("sga", "revenue"), "lvgi": part("total_debt", "assets")}
    terms = {k: r(*both(f)) for k, f in now_before.items()} | {"gmi": r(margin(p), margin(c)), "depi": r(wear(p), wear(c)), "sgi": r(c("revenue"), p("revenue")), "tata": r(c("net_income") - c("operating_cash"), c("assets"))}
    m = F.when(c("prev").isNotNull(), fin.manipulation_score(terms, digits))
    z = fin.distress_score(c("current_assets") - c("current_liabilities"), c("retained"), c("ebit"), c("equity"), c("revenue"), c("assets"), c("liabilities"), digits)
    less = lambda f: F.when(F.coalesce(c("assets"), F.lit(0.0)) != 0, f(c) < f(p))
    more = lambda f: f(c) > f(p)
    signals = [
        r(c("net_income"), c("assets")) > 0, c("operating_cash") > 0, more(part("net_income", "assets")), c("operating_cash") > c("net_income"), less(part("total_debt", "assets")), more(part("current_assets", "current_liabilities")),
        c("shares") <= p("shares"), more(part("gross_profit", "revenue")), more(part("revenue", "assets")),
    ]
    return b.select(key, year, m.alias("m"), z.alias("z"), fin.strength_score(signals).alias("f"))


def growth_pack(df: DataFrame, key: str, year: str, values: Sequence[str], spans: Sequence[int] = (3, 5)) -> DataFrame:
    """Adds <value>_growth against the year before and <value>_cagr_<n>; a missing year gives NULL."""
    out = df
    for n in (1, *spans):
        out = shifted(out, [key], year, n, values, f"__{n}")
    return out.select(*df.columns, *(fin.growth(F.col(v), F.col(f"{v}__1")).alias(f"{v}_growth") for v in values), *(fin.cagr(F.col(v), F.col(f"{v}__{n}"), n).alias(f"{v}_cagr_{n}") for v in values for n in spans))


def with_previous(df: DataFrame, key: str, order: str) -> DataFrame:
    """Adds ``prev``: the previous row of the key as a struct, whatever the gap."""
    return df.withColumn("prev", F.lag(F.struct(*df.columns)).over(Window.partitionBy(key).orderBy(order)))


def canonical_year(df: DataFrame, key: str, year: str, own: str, accession: str) -> DataFrame:
    """One row per key and year: the filing's own current period first, then the greatest accession."""
    return top_per_group(df, [key, year], [F.desc(own), F.desc(accession)])


def tenure(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """Adds ``changed`` (the name differs from the row before) and ``unchanged_so_far``: rows without a change up to here; it never resets."""
    w = Window.partitionBy(key).orderBy(order)
    clean = F.lower(F.trim(F.col(name)))
    out = df.withColumn("changed", F.coalesce(clean != F.lag(clean).over(w), F.lit(False)))
    return out.withColumn("unchanged_so_far", F.sum(F.when(F.col("changed"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def revisions(df: DataFrame, key: Sequence[str], as_of: str, ties: Sequence[Column]) -> DataFrame:
    """Adds is_current: the latest revision of each natural key; older ones stay."""
    return df.withColumn("is_current", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc_nulls_last(as_of), *ties)) == 1)


def effective_filings(df: DataFrame, key: Sequence[str], kind: str, filed: str, accession: str) -> DataFrame:
    """The last base or restatement of each key and the additions after it.

    ``kind`` is base, restatement or addition; additions before any base stand alone. Unknown kinds raise when the rows are read.
    """
    place = F.struct(filed, accession)
    base = F.max(F.when(F.col(kind).isin("base", "restatement"), place)).over(Window.partitionBy(*key))
    checked = F.when(F.col(kind).isin("base", "restatement", "addition"), F.col(kind)).otherwise(F.raise_error(F.concat(F.lit("an amendment lacks its type: "), F.coalesce(F.col(accession).cast("string"), F.lit("?")))).cast("string"))
    return df.withColumn(kind, checked).withColumn("__base", base).where(F.col("__base").isNull() | (place >= F.col("__base"))).drop("__base")


def period_changes(df: DataFrame, holder: Sequence[str], asset: str, period: str, shares: str, value: str, ties: Sequence[str] = ()) -> DataFrame:
    """Adds the change of shares since the holder's last period with the asset, in number and share, the holder's rank by value in the asset and period, and whether the row is the holder's latest of the asset."""
    w = Window.partitionBy(*holder, asset).orderBy(period, *ties)
    last = F.lag(shares).over(w)
    return df.withColumns({
        "change": F.col(shares) - last,
        "change_pct": F.when(last != 0, (F.col(shares) - last) / last),
        "holder_rank": F.rank().over(Window.partitionBy(asset, period).orderBy(F.coalesce(value, F.lit(0.0)).desc())),
        "is_latest": F.row_number().over(Window.partitionBy(*holder, asset).orderBy(F.desc(period), *(F.desc(t) for t in ties))) == 1,
    })


#: Exchanges that a primary ticker is preferably of (fixed values).
MAJOR_EXCHANGES = ["NASDAQ", "NYSE", "NYSE ARCA", "NYSE MKT", "AMEX", "BATS"]


def primary_tickers(df: DataFrame, key: str, ticker: str, exchange: str, order: Sequence[Column], preferred: str | None = None) -> DataFrame:
    """(key, ticker): of each key the first by ``order`` on the preferred exchange, else on a major one, else of all; upper case."""
    at = F.coalesce(F.upper(F.trim(exchange)), F.lit(""))
    place = F.when(at == preferred.strip().upper(), 0).when(at.isin(*MAJOR_EXCHANGES), 1).otherwise(2) if preferred else F.when(at.isin(*MAJOR_EXCHANGES), 1).otherwise(2)
    rows = df.where(F.col(key).isNotNull() & (F.trim(ticker) != ""))
    return top_per_group(rows, [key], [place, *order]).select(key, F.upper(F.trim(ticker)).alias(ticker))


def compensation(df: DataFrame, key: str, filing: str, name: str, role: str, year: str, total: str) -> DataFrame:
    """Adds comp_rank within the filing by total pay (unknown counts as 0), comp_change against the person's filing before, and whether the row is the role's latest."""
    was = F.lag(total).over(Window.partitionBy(key, name).orderBy(year))
    return df.withColumns({
        "comp_rank": F.rank().over(Window.partitionBy(key, filing).orderBy(F.coalesce(total, F.lit(0.0)).desc())),
        "comp_change": F.when(was != 0, (F.col(total) - was) / was),
        "is_current_role": F.row_number().over(Window.partitionBy(key, role).orderBy(F.desc(year))) == 1,
    })
