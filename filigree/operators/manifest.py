"""Filing lists: from parallel arrays to rows, filters, links, latest filings, tickers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROOT = "https://www.sec.gov/Archives/edgar/data"
ANNUAL_RE = "^(10-K|20-F|40-F)"
COVER_RE = "^(10-K|20-F|40-F|10-Q|8-K|6-K)"


def padded_cik(cik: Column) -> Column:
    """Ten digits."""
    return F.lpad(F.ltrim(cik.cast("string"), F.lit("0")), 10, "0")


def folder_url(cik: Column, accession: Column) -> Column:
    return F.concat(F.lit(f"{ROOT}/"), cik.cast("bigint").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")))


def links(cik: Column, accession: Column, document: Column) -> dict[str, Column]:
    """filing_url (null without a document), index_url, filing_detail_url and submission_txt_url."""
    folder = folder_url(cik, accession)
    return {
        "filing_url": F.when(F.coalesce(document, F.lit("")) != "", F.concat(folder, F.lit("/"), document)),
        "index_url": F.concat(folder, F.lit("/"), accession, F.lit("-index.htm")),
        "filing_detail_url": F.concat(folder, F.lit("/"), accession, F.lit("-index.html")),
        "submission_txt_url": F.concat(folder, F.lit("/"), accession, F.lit(".txt")),
    }


def instance_url(cik: Column, accession: Column, document: Column, inline: Column) -> Column:
    """Link of the extracted instance of an inline document; null for others and for documents that aren't htm or html."""
    parts = F.regexp_replace(document, r"(?i)^(.*)\.(html?)$", "$1_$2.xml")
    return F.when(F.coalesce(inline, F.lit(False)) & document.rlike(r"(?i)^.*\.html?$"), F.concat(folder_url(cik, accession), F.lit("/"), parts))


def parallel_rows(df: DataFrame, arrays: str, keys: Sequence[str]) -> DataFrame:
    """One row an index of the struct's parallel arrays, short and absent ones padded with null; pos counts from 0."""
    fields = df.select(f"{arrays}.*").schema
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"{arrays}.{f.name}"), F.array().cast(f.dataType)).alias(f.name) for f in fields])
    return df.select(*keys, F.posexplode(zipped).alias("pos", "row")).select(*keys, "pos", "row.*")


def filings(df: DataFrame, forms: Sequence[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filings of exactly these forms within the inclusive dates, newest first; rows without a date pass the bounds."""
    if forms:
        df = df.where(F.col("form_type").isin(*forms))
    for bound, test in ((start, lambda d: d >= F.lit(start)), (end, lambda d: d <= F.lit(end))):
        if bound:
            df = df.where(F.coalesce(test(F.col("filing_date")), F.lit(True)))
    return df.orderBy(F.desc("filing_date"), "accession_number")


def latest(df: DataFrame, key: str = "cik") -> DataFrame:
    """Each company's newest annual filing, else its newest that has a cover; newest_form is that of any filing."""
    order = [F.desc("filing_date"), F.asc("accession_number")]
    rank = F.when(F.col("form_type").rlike(ANNUAL_RE), 0).when(F.col("form_type").rlike(COVER_RE), 1).otherwise(2)
    w = Window.partitionBy(key)
    marked = df.withColumn("rank_", rank).withColumn("newest_form", F.first("form_type").over(w.orderBy(*order)))
    return marked.withColumn("n_", F.row_number().over(w.orderBy("rank_", *order))).where("n_ = 1 and rank_ < 2").drop("n_", "rank_")


def first_ticker(df: DataFrame) -> DataFrame:
    """cik and the ticker of smallest position."""
    return df.groupBy("cik").agg(F.min_by("ticker", "pos").alias("ticker"))


def last_cik(df: DataFrame) -> DataFrame:
    """upper-case ticker and the cik of greatest position."""
    return df.groupBy(F.upper("ticker").alias("ticker")).agg(F.max_by("cik", "pos").alias("cik"))


def resolve(queries: DataFrame, tickers: DataFrame) -> DataFrame:
    """query and cik: digits are a cik, anything else a ticker."""
    asked = queries.withColumn("up_", F.upper(F.trim("query")))
    found = asked.join(last_cik(tickers).select(F.col("ticker").alias("up_"), F.col("cik").cast("string").alias("cik_")), "up_", "left")
    return found.select("query", F.when(F.col("up_").rlike("^[0-9]+$"), F.col("up_").try_cast("bigint").cast("string")).otherwise(F.col("cik_")).alias("cik"))


def profile(df: DataFrame) -> DataFrame:
    """The registrant's columns of parsed submissions JSON, with formatted addresses."""
    address = lambda a: F.nullif(F.concat_ws(", ", *[F.nullif(F.col(f"addresses.{a}.{c}"), F.lit("")) for c in ("street1", "street2", "city", "stateOrCountryDescription", "zipCode")]), F.lit(""))
    return df.select(
        F.col("cik").cast("bigint").alias("cik"),
        F.col("name").alias("entity_name"),
        F.get("tickers", F.lit(0)).alias("ticker"),
        F.get("exchanges", F.lit(0)).alias("exchange"),
        "sic",
        F.col("sicDescription").alias("sic_description"),
        F.nullif(F.col("stateOfIncorporation"), F.lit("")).alias("incorporation_code"),
        F.nullif(F.col("stateOfIncorporationDescription"), F.lit("")).alias("incorporation_name"),
        F.col("addresses.business.stateOrCountry").alias("business_code"),
        address("business").alias("business_address"),
        address("mailing").alias("mailing_address"),
        F.array_join(F.transform("formerNames", lambda n: n["name"]), "; ").alias("former_names"),
    )
