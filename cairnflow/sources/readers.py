"""Readers of filing feeds: columnar and nested JSON, fixed-width indexes, CSV, XML; drifted shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parallel_arrays(df: DataFrame, payload: str, fields: Mapping[str, str], keep: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """One row per index of parallel JSON arrays (``fields``: name to element type); short arrays give NULL; ordinal from 0."""
    schema = ", ".join(f"`{n}` array<{k}>" for n, k in fields.items())
    source = F.get_json_object(payload, path) if path else F.col(payload)
    parsed = df.select(*keep, F.from_json(source, schema).alias("j"))
    zipped = F.arrays_zip(*(F.coalesce(F.col(f"j.{n}"), F.array().cast(f"array<{k}>")).alias(n) for n, k in fields.items()))
    return parsed.select(*keep, F.posexplode(zipped).alias("ordinal", "z")).select(*keep, "ordinal", *(F.col(f"z.{n}").alias(n) for n in fields))


def keyed_facts(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of {concept: {units: {unit: [{end, val, fp, start}]}}}: maps and arrays exploded, a missing start as 0001-01-01."""
    schema = "map<string, struct<units: map<string, array<struct<start: date, end: date, val: double, fy: int, fp: string, accn: string>>>>>"
    concepts = df.select(*keep, F.explode(F.from_json(payload, schema)).alias("concept", "body"))
    units = concepts.select(*keep, "concept", F.explode("body.units").alias("unit", "facts"))
    facts = units.select(*keep, "concept", "unit", F.explode("facts").alias("f"))
    return facts.select(*keep, "concept", "unit", F.coalesce("f.start", F.lit("0001-01-01").cast("date")).alias("period_start"), F.col("f.end").alias("period_end"), F.col("f.val").alias("value"), F.col("f.fy").alias("fiscal_year"), F.col("f.fp").alias("fiscal_period"), F.col("f.accn").alias("accession_number")).where(F.col("fiscal_period").isNull() | F.col("fiscal_period").isin("FY", "Q1", "Q2", "Q3", "Q4"))


def fixed_width_index(lines: DataFrame, line: str = "value", order: str | None = None) -> DataFrame:
    """Rows of a daily index text: row_ordinal, form, company, cik, filing date, file name, accession number, URL and the hash of the fields.

    Lines without 'edgar/data/' or of another shape are left out; a date that is none leaves out the row but takes an ordinal. ``order`` is the
    column of the line's place in the file; without it there is no ordinal. Ordinals are made by ranges of the place, not in one task.
    """
    pattern = r"^(\S[\S ]*?)\s{2,}(.+?)\s{2,}(\d{4,10})\s+(\d{8}|\d{4}-\d{2}-\d{2})\s+(edgar/data/\S+)"
    part = lambda i: F.regexp_extract(line, pattern, i)
    rows = lines.where(F.col(line).contains("edgar/data/") & F.col(line).rlike(pattern))
    if order:
        rows = rows.withColumn("__range", F.floor(F.col(order) / 100_000))
        rows = rows.withColumn("__in", F.row_number().over(Window.partitionBy("__range").orderBy(order)))
        sizes = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
        before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")  # one row per 100,000 lines
        rows = rows.join(before, "__range").withColumn("row_ordinal", F.col("__before") + F.col("__in"))
    filed = F.coalesce(F.try_to_date(part(4), "yyyyMMdd"), F.try_to_date(part(4)))
    accession = F.regexp_extract(part(5), r"^edgar/data/\d+/(\d{10}-\d{2}-\d{6})(?:-index\.[^/]+|\.txt)$", 1)
    named = rows.select(*(["row_ordinal"] if order else []), F.trim(part(1)).alias("form"), F.trim(part(2)).alias("company"), part(3).cast("long").alias("cik"), filed.alias("filed"), part(5).alias("file_name"), F.when(accession != "", accession).otherwise(part(5)).alias("accession_number"), F.concat(F.lit("https://www.sec.gov/Archives/"), part(5)).alias("filing_txt_url"))
    return named.where("filed IS NOT NULL").withColumn("record_hash", F.sha2(F.concat_ws("|", "form", "company", F.col("cik").cast("string"), F.col("filed").cast("string"), "file_name"), 256))


def ticker_rows(df: DataFrame, payload: str) -> DataFrame:
    """Rows of {fields: [...], data: [[...]]}, every value under its field's name, with its rank."""
    parsed = df.select(F.from_json(payload, "fields array<string>, data array<array<string>>").alias("j"))
    rows = parsed.select("j.fields", F.posexplode("j.data").alias("rank", "values"))
    return rows.select((F.col("rank") + 1).alias("source_rank"), F.map_from_arrays("fields", "values").alias("row"))


OWNER_XML = "reportingOwner array<struct<reportingOwnerId: struct<rptOwnerCik: string, rptOwnerName: string>>>, nonDerivativeTable struct<nonDerivativeTransaction: array<struct<securityTitle: struct<value: string>, transactionAmounts: struct<transactionShares: struct<value: double>>>>>"


def ownership_xml(df: DataFrame, payload: str, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(owners, transactions) of ownership documents in XML, with their index from 1."""
    parsed = df.select(*keep, F.from_xml(payload, OWNER_XML).alias("x"))
    owners = parsed.select(*keep, F.posexplode("x.reportingOwner").alias("i", "o")).select(*keep, (F.col("i") + 1).alias("owner_index"), F.col("o.reportingOwnerId.rptOwnerCik").alias("owner_cik"), F.col("o.reportingOwnerId.rptOwnerName").alias("owner_name"))
    moves = parsed.select(*keep, F.posexplode("x.nonDerivativeTable.nonDerivativeTransaction").alias("i", "t")).select(*keep, (F.col("i") + 1).alias("txn_index"), F.col("t.securityTitle.value").alias("security_title"), F.col("t.transactionAmounts.transactionShares.value").alias("shares"))
    return owners, moves


def csv_checked(spark: SparkSession, path: str, schema: str | T.StructType, key: Sequence[str]) -> DataFrame:
    """A typed CSV; raises if one key has rows that differ, exact repeats collapse."""
    rows = spark.read.csv(path, header=True, schema=schema).distinct()
    clash = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
    if clash:
        raise ValueError(f"{clash} keys have rows that differ")
    return rows


def scaled_value(value: Column, period: Column) -> Column:
    """13F values are in thousands up to 2022-09-30, in dollars after."""
    return F.when(period <= F.lit("2022-09-30").cast("date"), value * 1000).otherwise(value)


def union_shards(shards: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """All shards under ``columns``, missing ones NULL; a shard that has none of them is skipped."""
    out = None
    for s in shards:
        have = [c for c in columns if c in s.columns]
        if have:
            one = s.select(*have)
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no shard has any of the columns")
    return out.select(*(c for c in columns if c in out.columns))


SUBMISSION = "name string, entityType string, sic string, sicDescription string, stateOfIncorporation string, fiscalYearEnd string, ein string, category string, addresses map<string, struct<street1: string, street2: string, city: string, stateOrCountry: string, zipCode: string>>, formerNames array<struct<name: string, date: string>>, filings struct<files: array<struct<name: string, filingCount: bigint, filingFrom: string, filingTo: string>>>"


def submissions(df: DataFrame, payload: str, keep: Sequence[str]) -> dict[str, DataFrame]:
    """The company, its addresses by type, its former names (ordinal from 1) and its further files of a registrant's JSON; files without a name are none."""
    j = df.select(*keep, F.from_json(payload, SUBMISSION).alias("j")).where("j IS NOT NULL")
    company = j.select(*keep, F.col("j.name").alias("entity_name"), F.col("j.entityType").alias("entity_type"), "j.sic", F.col("j.sicDescription").alias("sic_description"), F.col("j.stateOfIncorporation").alias("state_of_incorporation"), F.col("j.fiscalYearEnd").alias("fiscal_year_end"), "j.ein", "j.category")
    a = j.select(*keep, F.explode("j.addresses").alias("address_type", "a")).where("a IS NOT NULL")
    former = j.select(*keep, F.posexplode("j.formerNames").alias("i", "f")).where("f IS NOT NULL")
    files = j.select(*keep, F.explode("j.filings.files").alias("f")).where("f.name <> ''")
    day = lambda c: F.try_to_date(F.substring(c, 1, 10))
    return {
        "company": company,
        "address": a.select(*keep, "address_type", "a.street1", "a.street2", "a.city", F.col("a.stateOrCountry").alias("state_or_country"), F.col("a.zipCode").alias("zip_code")),
        "former_name": former.select(*keep, F.col("f.name").alias("former_name"), day("f.date").alias("date_changed"), (F.col("i") + 1).alias("ordinal")),
        "manifest": files.select(*keep, F.col("f.name").alias("file_name"), F.col("f.filingCount").alias("filing_count"), day("f.filingFrom").alias("filing_from"), day("f.filingTo").alias("filing_to")),
    }


#: Annual forms, and the auditor's facts that filings of these carry (fixed values).
ANNUAL = ["10-K", "10-K/A", "20-F", "20-F/A", "40-F", "40-F/A"]
AUDITOR = {"AuditorName": "auditor_name", "AuditorFirmId": "auditor_pcaob_id", "AuditorLocation": "auditor_location", "IcfrAuditorAttestationFlag": "icfr_attestation"}


def auditor_facts(facts: DataFrame, accession: str, concept: str, form: str, value: str, at: str) -> DataFrame:
    """One row per annual filing with a column per auditor fact, the last by ``at`` where one comes twice; other forms and concepts have none."""
    rows = facts.where(F.col(form).isin(*ANNUAL) & F.col(concept).isin(*AUDITOR) & (F.col(accession) != ""))
    return rows.groupBy(accession).agg(*(F.max_by(F.trim(value), F.when((F.col(concept) == c) & F.col(value).isNotNull(), F.col(at))).alias(n) for c, n in AUDITOR.items()))


def thirteenf_cover(xml: Column) -> Column:
    """struct(is_amendment, amendment_type, confidential_omission, period_of_report) of a 13F cover page; an amendment of an unknown type raises."""
    text = lambda tag: F.nullif(F.trim(F.regexp_extract(xml, rf"(?is)<(?:\w+:)?{tag}>(.*?)</(?:\w+:)?{tag}>", 1)), F.lit(""))
    yes = lambda tag: F.coalesce(F.lower(text(tag)).isin("true", "1", "yes"), F.lit(False))
    raw, amended = F.lower(text("amendmentType")), yes("isAmendment")
    kind = F.when(~amended, None).when(raw.isin("restatement", "restated"), "restatement").when(raw.isin("new holdings", "new holdings entries", "added holdings", "addition"), "added_holdings").otherwise(F.raise_error(F.lit("an amendment lacks a known type")).cast("string"))
    period = F.replace(text("periodOfReport"), F.lit("/"), F.lit("-"))
    day = F.when(period.rlike(r"^\d{4}-\d+-\d+$"), F.substring(period, 1, 10)).when(period.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.concat_ws("-", F.split(period, "-")[2], F.lpad(F.split(period, "-")[0], 2, "0"), F.lpad(F.split(period, "-")[1], 2, "0")))
    return F.struct(amended.alias("is_amendment"), kind.alias("amendment_type"), yes("confidentialOmitted").alias("confidential_omission"), F.try_to_date(day).alias("period_of_report"))


def plausible_amount(value: Column, scale: Column) -> Column:
    """A table's amount, or NULL where it is smaller than the table's own scale (and not 0): it was then not scaled, or is of another row."""
    return F.when(~F.coalesce((scale > 1) & (value != 0) & (F.abs(value) < scale), F.lit(False)), value)
