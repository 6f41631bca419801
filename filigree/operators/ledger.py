"""The filing mirror: ledger of index days, planning, keyed merges, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINISHED, BACKLOG = ("parsed", "empty"), ("available", "failed")


def current(transitions: DataFrame) -> DataFrame:
    """idx_date and status by the transition of greatest seq; an available never replaces a later state."""
    real = F.col("status") != "available"
    latest = F.max_by("status", F.struct(real.cast("int"), F.col("seq")))
    return transitions.groupBy("idx_date").agg(latest.alias("status"), F.max("seq").alias("seq"))


def watermark(ledger: DataFrame) -> DataFrame:
    """One row: the greatest finished index date."""
    return ledger.agg(F.max(F.when(F.col("status").isin(*FINISHED), F.col("idx_date"))).alias("watermark"))


def summary(ledger: DataFrame) -> DataFrame:
    """Days by state, and the days' span."""
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in (*FINISHED, *BACKLOG)]
    return ledger.agg(F.count(F.lit(1)).alias("n_days"), F.min("idx_date").alias("first_date"), F.max("idx_date").alias("last_date"), *counts)


def pending(ledger: DataFrame, upto: Column) -> DataFrame:
    return ledger.where(F.col("status").isin(*BACKLOG) & (F.col("idx_date") <= upto)).select("idx_date").orderBy("idx_date")


def todo(discovered: DataFrame, ledger: DataFrame, end: Column) -> DataFrame:
    """idx_date and origin: discovered days that aren't finished, and older unfinished ones that weren't discovered."""
    done = ledger.where(F.col("status").isin(*FINISHED)).select("idx_date")
    new = discovered.select("idx_date").distinct().join(done, "idx_date", "left_anti").withColumn("origin", F.lit("discovered"))
    late = pending(ledger, end).join(discovered.select("idx_date"), "idx_date", "left_anti").withColumn("origin", F.lit("backlog"))
    return new.unionByName(late).orderBy("idx_date")


#: What a new value does to a stored one.
ALWAYS = ("entity_name", "form_type", "filing_date", "index_url", "filing_detail_url", "submission_txt_url", "source_idx_date", "source_idx_file")
UNLESS_BLANK = ("ticker", "primary_document", "filing_url")
UNLESS_NULL = ("report_date", "xbrl_instance_url", "file_number", "act", "size", "is_xbrl")
KEYS = ("accession_number", "cik")


def last_of_batch(incoming: DataFrame, order: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """A batch folded to one row a key, as if its rows came one after the other in the order column."""
    w = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "" if c in UNLESS_BLANK else F.lit(True)), F.col(order)))
    out = []
    for c in incoming.columns:
        if c in keys or c == order:
            continue
        out.append((F.max_by(c, order) if c in ALWAYS else F.max(c) if c == "enriched" else w(c)).alias(c))
    return incoming.groupBy(*keys).agg(*out)


def upserted(stored: DataFrame, incoming: DataFrame, run: Column, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """stored after a merge with a batch of one row a key.

    stored has the incoming columns and first_seen_run, last_seen_run,
    ingested_at and updated_at.  Some columns are overwritten, some kept if the
    new value is blank or null, enriched only rises, first_seen_run and
    ingested_at never change, updated_at is null for a new row.
    """
    columns = [c for c in incoming.columns if c not in keys]
    old = stored.select(*keys, F.lit(True).alias("in_old"), *[F.col(c).alias(f"{c}_old") for c in stored.columns if c not in keys])
    new = incoming.select(*keys, F.lit(True).alias("in_new"), *[F.col(c).alias(f"{c}_new") for c in columns])
    both = old.join(new, [*keys], "full_outer")
    came, is_new = F.col("in_new").isNotNull(), F.col("in_old").isNull()

    def merged(c: str) -> Column:
        o, n = F.col(f"{c}_old"), F.col(f"{c}_new")
        if c == "enriched":
            return F.greatest(o, n)
        if c in UNLESS_BLANK:
            return F.coalesce(F.nullif(n, F.lit("")), F.when(is_new, n).otherwise(o))
        return F.coalesce(n, o) if c in UNLESS_NULL else F.when(came, n).otherwise(o)

    return both.select(
        *keys,
        *[merged(c).alias(c) for c in columns],
        F.when(is_new, run).otherwise(F.col("first_seen_run_old")).alias("first_seen_run"),
        F.when(came, run).otherwise(F.col("last_seen_run_old")).alias("last_seen_run"),
        F.when(is_new, now).otherwise(F.col("ingested_at_old")).alias("ingested_at"),
        F.when(came & ~is_new, now).otherwise(F.col("updated_at_old")).alias("updated_at"),
    )


def unenriched(filings: DataFrame, forms: Sequence[str] | None = None, since: str | None = None, until: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows still to be enriched, oldest first."""
    out = filings.where(F.coalesce("enriched", F.lit(0)) == 0)
    if forms:
        out = out.where(F.col("form_type").isin(*forms))
    if since:
        out = out.where(F.col("filing_date") >= F.lit(since))
    if until:
        out = out.where(F.col("filing_date") <= F.lit(until))
    out = out.orderBy("filing_date", "accession_number")
    return out if limit is None else out.limit(limit)


def runs(log: DataFrame, k: int) -> DataFrame:
    """The k newest runs, each folded from its rows in the log (opened, closed)."""
    folded = log.groupBy("run_id").agg(F.min("at").alias("started"), F.max_by("status", "at").alias("status"), F.max("rows").alias("rows"))
    return folded.orderBy(F.desc("run_id")).limit(k)


def failure_runs(events: DataFrame, group: str, order: Sequence[str], failed: Column) -> DataFrame:
    """group, first, last and length of every run of consecutive failures."""
    w = Window.partitionBy(group).orderBy(*order)
    marked = events.withColumn("f_", failed).withColumn("i_", F.row_number().over(w))
    bad = marked.where("f_").withColumn("island_", F.col("i_") - F.row_number().over(Window.partitionBy(group).orderBy("i_")))
    return bad.groupBy(group, "island_").agg(F.min("i_").alias("first"), F.max("i_").alias("last"), F.count(F.lit(1)).alias("length")).drop("island_")
