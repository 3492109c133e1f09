"""Surrogate, date and natural keys; text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(c: Column) -> Column:
    """63-bit key from the first 8 bytes of SHA-256, NULL for NULL; the same in every engine."""
    number = F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (number % F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")


def date_key(c: Column) -> Column:
    """YYYYMMDD as a whole number, NULL for NULL."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def fiscal_year_key(year: Column) -> Column:
    return (year * 10000 + 1231).cast("int")


def clean_text(c: Column) -> Column:
    """Blanks collapsed and trimmed, '' as NULL; case kept."""
    return F.nullif(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")), F.lit(""))


def normalized_text(c: Column) -> Column:
    return F.lower(clean_text(c))


def party_key(cik: Column, name: Column) -> Column:
    """'cik:<n>' where a number is known, else 'name:<normalised name>', else NULL."""
    return F.coalesce(F.concat(F.lit("cik:"), cik.cast("string")), F.concat(F.lit("name:"), normalized_text(name)))


def security_key(issuer: Column, title: Column) -> Column:
    return F.concat_ws("|", F.coalesce(issuer.cast("string"), F.lit("0")), normalized_text(title))


def geography_key(state: Column, country: Column) -> Column:
    return F.concat(F.coalesce(state, F.lit("")), F.lit("|"), F.coalesce(country, F.lit("")))


def cik_text(c: Column) -> Column:
    """Ten digits from any writing of a registrant number; longer ones keep all digits."""
    digits = F.regexp_replace(c.cast("string"), r"\D", "")
    return F.when(digits != "", F.when(F.length(digits) >= 10, digits).otherwise(F.lpad(digits, 10, "0")))


def shard_of(c: Column, shards: int) -> Column:
    """Shard number from the MD5 of a key, the same in every engine."""
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint") % shards).cast("int")


def name_uuid(namespace: str, name: Column) -> Column:
    """Version 5 UUID of ``name`` under ``namespace`` (32 hex digits), as text."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
