"""Whole plans: submissions to their tables, a company's derived facts, and the monthly monitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions import text as tx
from filigree.operators import country, derived, submission


def processed(raw: DataFrame, key: str = "accession_number", named: str | None = None, categories: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """documents, html, text, statements, tables, headers and covers of raw submissions (key, text, and a column named for the primary document if given).

    All are lazy; what isn't used isn't computed.
    """
    keys = [key] if named is None else [key, named]
    docs = submission.documents(raw, keys=keys)
    html = submission.primary(docs, keys, named).select(key, "filename", tx.html_clean(F.col("body")).alias("html"))
    texts = html.select(key, tx.html_text(F.col("html")).alias("text"))
    return {
        "documents": docs,
        "html": html,
        "text": texts,
        "statements": submission.statements(texts, keys=[key]),
        "tables": submission.tables(html, key=key, categories=categories),
        "headers": submission.header_fields(raw).drop("text"),
        "covers": country.cover(texts, "text", key),
    }


def write_html(html: DataFrame, path: str, *identity: str) -> None:
    """Cleaned documents as compressed Parquet with a safe file name each."""
    html.withColumn("slug", tx.slug(*[F.col(c).cast("string") for c in identity])).write.option("compression", "gzip").mode("overwrite").parquet(path)


def company_results(profiles: DataFrame, securities: DataFrame, texts: DataFrame, use_prose: bool = True) -> DataFrame:
    """kind, cik, source_accession and JSON payload of industry, voting and depositary facts, ready for the store.

    profiles: cik, sic; securities: cik, accession_number, security_title,
    security_class; texts: cik, accession_number, source_rank, text.
    """
    source = texts.groupBy("cik").agg(F.min_by("accession_number", F.struct("source_rank", "accession_number")).alias("source_accession"))
    icb = derived.classified(profiles.select("cik", "sic")).select("cik", F.to_json(F.struct("industry_code", "industry", "method", "confidence")).alias("payload"))
    voting = derived.voting_rights(texts).groupBy("cik").agg(F.array_sort(F.collect_list(F.struct("class_label", "votes_per_share", "confidence"))).alias("v")).select("cik", F.to_json("v").alias("payload"))
    ratios = derived.adr_ratios(securities, texts.select("accession_number", "text") if use_prose else None)
    adr = ratios.groupBy("cik", F.col("accession_number").alias("source_accession")).agg(F.array_sort(F.collect_list(F.struct("security_title", "shares_per_ads", "underlying", "display", "method", "confidence"))).alias("v")).select("cik", "source_accession", F.to_json("v").alias("payload"))
    named = [df.withColumn("kind", F.lit(kind)).join(source, "cik", "left") for kind, df in (("icb", icb), ("voting", voting))]
    columns = ["kind", "cik", "source_accession", "payload"]
    every = named[0].select(columns).unionByName(named[1].select(columns)).unionByName(adr.withColumn("kind", F.lit("adr")).select(columns))
    return every.withColumn("source_accession", F.coalesce("source_accession", F.lit("")))


def monitored(profiles: DataFrame, evidence: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(the month's assignments, their differences from the snapshot before)."""
    now = country.assignments(profiles, evidence)
    return now, None if before is None else country.snapshot_diff(before, now)


def start_date(ledger: DataFrame, override: str | None = None) -> DataFrame:
    """One row: the override or the day after the watermark, lowered to the oldest unfinished day."""
    from filigree.operators.ledger import BACKLOG, FINISHED

    day = lambda states: F.when(F.col("status").isin(*states), F.to_date("idx_date"))
    first: Column = F.to_date(F.lit(override)) if override else F.date_add(F.max(day(FINISHED)), 1)
    return ledger.agg(F.date_format(F.least(first, F.min(day(BACKLOG))), "yyyy-MM-dd").alias("start"))
