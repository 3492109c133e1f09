"""Reading numbers, labels and signals out of text."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def scaled_number(c: Column) -> Column:
    """'1.2 billion' as 1.2e9; NULL where no number is found."""
    low = F.lower(F.regexp_replace(c, ",", ""))
    n = F.nullif(F.regexp_extract(low, r"(-?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    unit = F.regexp_extract(low, r"\d\s*(trillion|billion|million|thousand|bn|mm|tn|k|m|b)\b", 1)
    factor = F.when(unit.isin("trillion", "tn"), 1e12).when(unit.isin("billion", "bn", "b"), 1e9).when(unit.isin("million", "mm", "m"), 1e6).when(unit.isin("thousand", "k"), 1e3).otherwise(1.0)
    return n * factor


def guided_range(c: Column) -> Column:
    """struct(low, mid, high) of a guidance cell: two numbers parted by a dash or 'to' between blanks, or one number anywhere in the text.

    A leading '-' or '($' makes a number negative; brackets alone don't. Ends come in order. 'N/A', 'NA', '-', '--', '' and texts without a digit give NULLs.
    """
    text = F.trim(c)

    def number(t: Column) -> Column:
        digits = F.replace(F.regexp_extract(t, r"-?\$?\s*([\d,]+\.?\d*)", 1), F.lit(","), F.lit(""))
        value = F.when(~digits.isin("", "."), digits.try_cast("double"))
        return F.when(F.trim(t).startswith("-") | F.trim(t).startswith("($"), -F.abs(value)).otherwise(value)

    parts = F.split(text, r"\s+(?:-|to|–|—)\s+")
    two = F.size(parts) == 2
    a, b = number(F.get(parts, F.lit(0))), number(F.get(parts, F.lit(1)))
    ranged = two & a.isNotNull() & b.isNotNull()
    one = F.when(~F.upper(text).isin("", "N/A", "NA", "-", "--"), number(text))
    return F.struct(F.when(ranged, F.least(a, b)).otherwise(one).alias("low"), F.when(ranged, (a + b) / 2).otherwise(one).alias("mid"), F.when(ranged, F.greatest(a, b)).otherwise(one).alias("high"))


def first_label(c: Column, labels: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first fragment that the text contains, case ignored."""
    out = F.lit(default)
    for fragment, label in reversed(labels):
        out = F.when(F.lower(c).contains(fragment), label).otherwise(out)
    return out


def form_family(c: Column) -> Column:
    """Family of a filing form by its prefix; NULL and unknown forms are 'other'."""
    return (
        F.when(c.startswith("10-K"), "10-K").when(c.startswith("10-Q"), "10-Q").when(c.startswith("8-K"), "8-K")
        .when(c.isin("3", "3/A", "4", "4/A", "5", "5/A"), "ownership").when(c.startswith("ADV"), "adv").when(c.startswith("DEF 14") | c.startswith("PRE 14"), "proxy").otherwise("other")
    )


#: Patterns of security titles by class, the first that matches counts (fixed values).
TITLE_CLASSES = [
    ("fixed_income", r"(?i)\b(note|notes|bond|bonds|deb|debenture|sr\.?\s+note|senior\s+note)\b"),
    ("etf_fund", r"(?i)\b(etf|fund|trust|tr\s+unit|trust\s+unit|index\s+fund|spdr|ishare)\b"),
    ("warrant", r"(?i)\b(wt|warr|warrant|warrants)\b"),
]


def security_class(title: Column, ticker: Column | None = None) -> Column:
    """equity where a ticker is known, else the class of the first pattern that the title matches, else unknown_security."""
    out = F.lit("unknown_security")
    for name, pattern in reversed(TITLE_CLASSES):
        out = F.when(title.rlike(pattern), name).otherwise(out)
    return out if ticker is None else F.when(~F.coalesce(F.trim(ticker), F.lit("")).isin("", "nan", "None"), "equity").otherwise(out)


#: Metrics of guidance labels, the first whose fragment the label contains (fixed values), and what marks an adjusted one.
GUIDED = [
    *((x, "eps_diluted") for x in ("diluted eps", "diluted earnings per share", "eps - diluted", "eps, diluted", "earnings per diluted share")), *((x, "eps_basic") for x in ("basic eps", "basic earnings per share", "eps - basic", "eps, basic", "earnings per basic share")),
    ("ebitda", "ebitda"), ("ebit", "ebit"), ("free cash flow", "free_cash_flow"), ("fcf", "free_cash_flow"), ("capital expenditure", "capex"), ("capex", "capex"), ("gross profit", "gross_profit"), ("operating margin", "operating_margin"),
    ("net income", "net_income"), ("net earnings", "net_income"), ("revenue", "revenue"), ("net sales", "revenue"), ("total sales", "revenue"), ("net revenue", "revenue"),
]
ADJUSTED = ["non-gaap", "non gaap", "adjusted", "as adjusted"]


def guided_metric(label: Column) -> Column:
    """struct(metric, is_non_gaap, unit) of a guidance label; unknown and missing labels are 'other' in USD."""
    metric = first_label(F.trim(label), GUIDED, "other")
    adjusted = F.coalesce(F.lower(label).rlike("|".join(ADJUSTED)), F.lit(False))
    unit = F.when(metric.isin("eps_diluted", "eps_basic"), "per_share").when(metric == "operating_margin", "percent").otherwise("USD")
    return F.struct(metric.alias("metric"), adjusted.alias("is_non_gaap"), unit.alias("unit"))


def quarter_of(fp: Column) -> Column:
    """Quarter of a fiscal period code; NULL for a whole year."""
    return F.when(F.upper(fp).rlike(r"^Q[1-4]$"), F.substring(fp, 2, 1).cast("int"))


def data_state(value: Column, history: Column | None = None, covered: Column | None = None) -> Column:
    """coverage_unavailable, insufficient_history, value_unavailable, numeric_zero or available, in this order of precedence."""
    history = F.lit(True) if history is None else history
    covered = F.lit(True) if covered is None else covered
    return F.when(~covered, "coverage_unavailable").when(~history, "insufficient_history").when(value.isNull(), "value_unavailable").when(value == 0, "numeric_zero").otherwise("available")


def row_hash(*columns: Column) -> Column:
    """SHA-256 over the texts of columns, NULL apart from ''."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)


@lru_cache(maxsize=200_000)
def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity; 1 for two empty texts, 0 against one."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if taken[j]]
    m, swaps = len(hits), sum(x != y for x, y in zip(hits, other)) // 2  # half of an odd one does not count
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def jaro_winkler_rows(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """jaro_winkler of as many pairs of texts of one length each, given as rows of codes, at most 64 a row; 0 where ``least`` isn't reached."""
    (n, i), j = a.shape, b.shape[1]
    reach = max(0, max(i, j) // 2 - 1)
    taken, hit = np.zeros(n, dtype=np.uint64), np.zeros((n, i), dtype=bool)
    wide = np.zeros((n, 64), dtype=bool)
    for k in range(i):
        np.equal(b, a[:, k, None], out=wide[:, :j])
        wide[:, : max(0, k - reach)] = False
        wide[:, min(j, k + reach + 1) : j] = False
        free = np.packbits(wide, axis=1, bitorder="little").view(np.uint64)[:, 0] & ~taken
        first = free & (~free + np.uint64(1))
        taken |= first
        hit[:, k] = first != 0
    m = hit.sum(1)
    same = np.logical_and.accumulate(a[:, :4][:, : min(i, j)] == b[:, :4][:, : min(i, j)], axis=1).sum(1)

    def score(m: np.ndarray, swaps, same: np.ndarray) -> np.ndarray:
        jaro = (m / i + m / j + (m - swaps) / np.maximum(m, 1)) / 3
        return np.where(jaro > 0.7, jaro + 0.1 * same * (1 - jaro), jaro)

    out = np.zeros(n)
    at = np.flatnonzero((m > 0) & (score(m, 0, same) >= least))
    if len(at):
        left = np.take_along_axis(a[at], np.argsort(~hit[at], axis=1, kind="stable"), 1)
        theirs = np.unpackbits(taken[at].view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")[:, :j] > 0
        right = np.take_along_axis(b[at], np.argsort(~theirs, axis=1, kind="stable"), 1)
        both = min(i, j)
        swaps = ((left[:, :both] != right[:, :both]) & (np.arange(both) < m[at, None])).sum(1) // 2
        out[at] = score(m[at], swaps, same[at])
    return np.where(out >= least, out, 0.0)


@F.pandas_udf(DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler over Arrow batches; NULL with NULL."""
    return pd.Series([None if x is None or y is None else jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


#: Words that names are freed of before they are compared (fixed values).
LEGAL_WORDS = ["inc", "incorporated", "llc", "corp", "corporation", "lp", "ltd", "limited", "plc", "trust", "fund", "group", "partners", "associates", "co", "na", "holdings", "services"]
#: Short forms of officers' titles (fixed values).
TITLES = {
    "CHIEF EXECUTIVE OFFICER": "CEO", "CEO": "CEO", "CHIEF FINANCIAL OFFICER": "CFO", "CFO": "CFO", "CHIEF OPERATING OFFICER": "COO", "COO": "COO", "CHIEF TECHNOLOGY OFFICER": "CTO", "CTO": "CTO",
    "CHIEF INVESTMENT OFFICER": "CIO", "CIO": "CIO", "DIRECTOR": "Director", "BOARD DIRECTOR": "Director", "EXECUTIVE VICE PRESIDENT": "EVP",
}


def capitalised(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), " ")


def bare_title(c: Column) -> Column:
    """An officer's title under its short form, else its words with capitals in front; punctuation is a blank."""
    raw = F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), r"[^\w\s]", " "), r"\s+", " "))
    known = F.create_map(*(F.lit(x) for kv in TITLES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, raw), capitalised(F.split(raw, " ")))


def bare_name(c: Column) -> Column:
    """Words of a name without legal forms, with capitals in front, joined by one blank; NULL if nothing is left."""
    words = F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\w\s]", " ")), r"\s+"), lambda w: (w != "") & ~w.isin(*LEGAL_WORDS))
    return F.nullif(capitalised(words), F.lit(""))
