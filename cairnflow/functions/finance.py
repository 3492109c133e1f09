"""Ratios, growth and scores that treat a missing value as missing, never as zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(n: Column, d: Column) -> Column:
    """n / d; NULL if either is NULL or d is 0."""
    return F.when(d != 0, n / d)


def safe_ratio_signed(n: Column, d: Column) -> Column:
    """n / d for positive d only: a return on negative equity has no meaning."""
    return F.when(d > 0, n / d)


def growth(current: Column, prior: Column) -> Column:
    return F.when(prior != 0, (current - prior) / prior)


def cagr(current: Column, prior: Column, years: int) -> Column:
    """Compound yearly growth; NULL unless both ends are positive."""
    return F.when((current > 0) & (prior > 0), F.pow(current / prior, F.lit(1.0 / years)) - 1)


def enterprise_value(cap: Column, debt: Column, cash: Column) -> Column:
    return F.when(cap > 0, cap + F.coalesce(debt, F.lit(0.0)) - F.coalesce(cash, F.lit(0.0)))


def weighted_terms(terms: Sequence[tuple[float, Column]], constant: float, least: int, digits: int = 4) -> Column:
    """constant + sum of weight * term over the terms that are known; NULL if fewer than ``least`` are."""
    known = sum((F.when(t.isNotNull(), 1).otherwise(0) for _, t in terms), F.lit(0))
    total = sum((F.coalesce(F.lit(w) * t, F.lit(0.0)) for w, t in terms), F.lit(constant))
    return F.when(known >= least, F.round(total, digits))


def manipulation_score(terms: dict[str, Column], digits: int = 4) -> Column:
    """Beneish M from its eight indices (dsri, gmi, aqi, sgi, depi, sgai, lvgi, tata); at least two must be known."""
    weights = {"dsri": 0.920, "gmi": 0.528, "aqi": 0.404, "sgi": 0.892, "depi": 0.115, "sgai": -0.172, "tata": 4.679, "lvgi": -0.327}
    return weighted_terms([(w, terms[k]) for k, w in weights.items()], -4.84, 2, digits)


def distress_score(working: Column, retained: Column, earnings: Column, equity: Column, sales: Column, assets: Column, liabilities: Column, digits: int = 4) -> Column:
    """Altman Z; NULL without assets, at least two of the five terms must be known."""
    a = F.nullif(assets, F.lit(0.0))
    return F.when(a.isNotNull(), weighted_terms([(1.2, working / a), (1.4, retained / a), (3.3, earnings / a), (0.6, safe_ratio(equity, liabilities)), (1.0, sales / a)], 0.0, 2, digits))


def strength_score(signals: Sequence[Column]) -> Column:
    """Piotroski F: the number of signals that hold; unknown ones don't, all unknown gives NULL."""
    known = F.filter(F.array(*signals), lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.size(F.filter(known, lambda x: x)))


def manipulation_tier(m: Column) -> Column:
    return F.when(m.isNull(), "unknown").when(m > -1.78, "high").when(m >= -2.22, "medium").otherwise("low")


def distress_tier(z: Column) -> Column:
    return F.when(z.isNull(), "unknown").when(z < 1.81, "distress").when(z <= 2.99, "grey").otherwise("safe")


def strength_tier(f: Column) -> Column:
    return F.when(f.isNull(), "unknown").when(f >= 7, "strong").when(f.between(3, 6), "neutral").otherwise("weak")


def cost_of_capital(cap: Column, debt: Column, beta: Column, interest: Column, tax: Column, pretax: Column, risk_free: Column | None = None, premium: float = 0.057, tax_cap: float = 0.40, tax_default: float = 0.21) -> Column:
    """struct(wacc, cost_of_equity, cost_of_debt, tax_rate, assumed): NULL without a positive market value.

    Interest counts by its size; without debt its cost is unknown and adds nothing. The tax rate is expense over pretax
    income where that is positive, at most ``tax_cap``, else the statutory one. ``assumed`` names what was missing.
    """
    rate = F.lit(None).cast("double") if risk_free is None else risk_free
    d = F.coalesce(debt, F.lit(0.0))
    ke = F.coalesce(rate, F.lit(0.04)) + F.coalesce(beta, F.lit(1.0)) * premium
    kd = F.when(debt > 0, F.abs(interest) / debt)
    known = tax.isNotNull() & (pretax > 0)
    t = F.when(known, F.least(tax / pretax, F.lit(tax_cap))).otherwise(F.lit(tax_default))
    value = cap / (cap + d) * ke + F.coalesce(d / (cap + d) * kd * (1 - t), F.lit(0.0))
    assumed = F.when(cap > 0, F.array_compact(F.array(F.when(beta.isNull(), "beta"), F.when(rate.isNull(), "risk_free_rate"), F.when(~F.coalesce(known, F.lit(False)) & (d > 0), "tax_rate")))).otherwise(F.array(F.lit("market_cap")))
    return F.struct(*(F.when(cap > 0, v).alias(n) for n, v in (("wacc", F.round(value, 6)), ("cost_of_equity", ke), ("cost_of_debt", kd), ("tax_rate", t))), assumed.alias("assumed"))
