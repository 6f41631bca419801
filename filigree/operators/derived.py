"""Derived facts: industries, depositary ratios, voting rights, and the reviewed store of them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from filigree import data
from filigree.functions import ratio as rt
from filigree.functions.text import joined
from filigree.functions.text import sentences as tx_sentences

CONFIDENCE = ("high", "medium", "low", "review")


def sic_prior(df: DataFrame, sic: str = "sic") -> DataFrame:
    """df with industry_code, industry and sector_hint of the narrowest range that holds the code; null in gaps.

    The 78 ranges are spread to at most 10,000 codes, so the join is on equality.
    """
    spark = df.sparkSession
    ranges = data.sic_table(spark).withColumn("code_", F.explode(F.sequence("sic_start", "sic_end")))
    best = ranges.groupBy("code_").agg(F.min_by(F.struct("industry_code", "sector_hint"), F.struct(F.col("sic_end") - F.col("sic_start"), "sic_start")).alias("b")).select("code_", "b.*")
    names = data.industry_table(spark).select("industry_code", "industry").distinct()
    table = best.join(names, "industry_code", "left").select("code_", "industry_code", "industry", "sector_hint")
    return df.join(F.broadcast(table), F.col(sic).try_cast("int") == F.col("code_"), "left").drop("code_")  # at most 10,000 rows


def classified(df: DataFrame, sector: str | None = None) -> DataFrame:
    """df (sic) with the industry by prior, or by the sector code in column sector where a model gave one.

    A hint of the same industry replaces the model's sector.  Confidence: high
    if prior and model agree, review if not, medium without prior, low without model.
    """
    out = sic_prior(df).withColumnRenamed("industry_code", "prior_code").withColumnRenamed("industry", "prior_industry")
    given = F.col(sector) if sector else F.lit(None).cast("string")
    table = data.industry_table(df.sparkSession).select("sector_code", "sector", "supersector_code", "supersector", F.col("industry_code").alias("model_code"), F.col("industry").alias("model_industry")).distinct()
    chosen = F.when(given.isNotNull() & F.col("sector_hint").isNotNull() & (F.substring("sector_hint", 1, 2) == F.substring(given, 1, 2)), F.col("sector_hint")).otherwise(given)
    out = out.withColumn("sector_", chosen).join(F.broadcast(table), F.col("sector_") == F.col("sector_code"), "left").drop("sector_")  # 45 rows
    model, prior = F.col("model_code").isNotNull(), F.col("prior_code").isNotNull()
    method = F.when(model & prior, "llm+sic").when(model, "llm").when(prior, "sic")
    confidence = F.when(model & prior, F.when(F.col("prior_code") == F.col("model_code"), "high").otherwise("review")).when(model, "medium").when(prior, "low")
    return out.withColumn("industry_code", F.coalesce("model_code", "prior_code")).withColumn("industry", F.coalesce("model_industry", "prior_industry")).withColumn("method", method).withColumn("confidence", confidence).drop("model_code", "model_industry", "prior_code")


def path(df: DataFrame, *levels: str) -> Column:
    """The levels' names parted by ' > ', equal neighbours once."""
    every = F.filter(F.array(*levels), lambda x: x.isNotNull())
    return F.array_join(F.filter(every, lambda x, i: (i == 0) | (x != F.get(every, i - 1))), " > ")


@F.pandas_udf(T.DoubleType())
def quantity(phrases: pd.Series) -> pd.Series:
    return phrases.map(rt.quantity)


_RATIO = T.StructType([T.StructField("shares_per_ads", T.DoubleType()), T.StructField("underlying", T.StringType()), T.StructField("evidence", T.StringType())])
_VOTE = T.StructType([T.StructField("class_label", T.StringType()), T.StructField("votes", T.DoubleType()), T.StructField("relative_to", T.StringType()), T.StructField("evidence", T.StringType())])


def _frame(found: list) -> pd.DataFrame:
    return pd.DataFrame([f or (None, None, None) for f in found], columns=["shares_per_ads", "underlying", "evidence"])


@F.pandas_udf(_RATIO)
def title_ratio(titles: pd.Series) -> pd.DataFrame:
    return _frame([rt.ratio(t) if t and rt.DEPOSITARY.search(t) else None for t in titles])


def _prose(text: str | None) -> tuple | None:
    for s in rt.ratio_sentences(text):
        if found := rt.ratio(s, prose=True):
            return found[0], found[1], s
    return None


@F.pandas_udf(_RATIO)
def prose_ratio(texts: pd.Series) -> pd.DataFrame:
    return _frame([_prose(t) for t in texts])


def is_ads(title: Column, member: Column) -> Column:
    return F.coalesce(title.rlike(r"(?i)american\s+depositar[yi]"), F.lit(False)) | F.coalesce(F.lower(member).rlike("depositary|ads|adr"), F.lit(False))


def ratio_display(n: Column, label: Column) -> Column:
    whole = lambda c: F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(F.regexp_replace(F.format_number(c, 4), r"0+$", ""))
    noun = F.coalesce(label, F.lit("shares"))
    return F.when(n >= 1, F.concat(F.lit("1 ADS : "), whole(n), F.lit(" "), noun)).when(n > 0, F.concat(whole(F.round(1 / n, 4)), F.lit(" ADS : 1 "), noun))


def adr_ratios(securities: DataFrame, texts: DataFrame | None = None, key: str = "accession_number") -> DataFrame:
    """Depositary securities with shares_per_ads, underlying, method, confidence, evidence and display.

    The title decides; only rows that it leaves open meet their filing's text
    (key, text) and are read in prose.  The others join under keys of their own
    that no text has, spread evenly.
    """
    rows = securities.where(is_ads(F.col("security_title"), F.col("security_class"))).withColumn("r_", title_ratio("security_title"))
    open_ = F.col("r_.shares_per_ads").isNull()
    if texts is None:
        every = rows.withColumn("p_", F.lit(None).cast(_RATIO))
    else:
        asked = F.when(open_, F.col(key)).otherwise(F.concat(F.lit("no text "), F.pmod(F.xxhash64("security_title", key), F.lit(100_000)).cast("string")))
        every = rows.withColumn("k_", asked).join(texts.select(F.col(key).alias("k_"), F.col("text").alias("t_")), "k_", "left").withColumn("p_", prose_ratio("t_"))
    method = F.when(~open_, "regex-title").when(F.col("p_.shares_per_ads").isNotNull(), "regex-text")
    every = every.select(*securities.columns, F.when(open_, F.col("p_")).otherwise(F.col("r_")).alias("x_"), method.alias("method")).select(*securities.columns, "x_.*", "method")
    return every.withColumn("confidence", F.when(F.col("method").isNull(), "low").otherwise("high")).withColumn("display", ratio_display(F.col("shares_per_ads"), F.col("underlying")))


@F.arrow_udf(T.ArrayType(_VOTE))
def vote_statements(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(_VOTE.names, v)) for v in rt.votes(t)] for t in texts.to_pylist()], to_arrow_type(T.ArrayType(_VOTE)))


def voting_rights(texts: DataFrame, key: str = "cik") -> DataFrame:
    """key, class_label, votes_per_share, confidence and evidence; texts: key, source_rank (annual report before proxy) and text.

    Of several sources the first that states anything counts.  Relative votes
    are multiplied with the class that they refer to.  Statements that agree
    give confidence high, others review and the first value.  Each text is read
    once; a key's statements are brought together once and resolved in place.
    """
    rows = texts.select(key, "source_rank", F.posexplode(vote_statements("text")).alias("pos", "v")).select(key, "source_rank", "pos", "v.*")
    packed = rows.groupBy(key).agg(F.min("source_rank").alias("best_"), F.array_sort(F.collect_list(F.struct("source_rank", "pos", "class_label", "votes", "relative_to", "evidence"))).alias("a_"))
    packed = packed.withColumn("a_", F.filter("a_", lambda x: x["source_rank"] == F.col("best_")))
    absolute = F.filter("a_", lambda x: x["relative_to"].isNull())
    classes = F.array_distinct(F.transform(absolute, lambda x: x["class_label"]))
    first = lambda c: F.get(F.filter("a_", lambda x: x["relative_to"].isNull() & (x["class_label"] == c)), F.lit(0))["votes"]
    packed = packed.withColumn("base_", F.map_from_entries(F.transform(classes, lambda c: F.struct(c.alias("k"), first(c).alias("v")))))
    resolved = packed.select(key, "base_", F.inline("a_")).withColumn("n_", F.when(F.col("relative_to").isNull(), F.col("votes")).otherwise(F.col("votes") * F.try_element_at("base_", F.col("relative_to")))).where("n_ is not null")
    return resolved.groupBy(key, "class_label").agg(
        F.min_by("n_", "pos").alias("votes_per_share"),
        F.when(F.min("n_") == F.max("n_"), "high").otherwise("review").alias("confidence"),
        F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "evidence"))), lambda x: x["evidence"])), "\n").alias("evidence"),
    )


@F.pandas_udf(T.StringType())
def business_description(texts: pd.Series, forms: pd.Series) -> pd.Series:
    return pd.Series([rt.business_description(t, f) for t, f in zip(texts, forms)], dtype=object)


def with_model(df: DataFrame, prompt: str, out: str, load: Callable[[], Callable[[str], str]], schema: str) -> DataFrame:
    """df with column out: the model's JSON answer to the prompt, parsed to schema; load runs once a worker."""
    kind = df.withColumn("json_", F.lit(None).cast("string")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            yield frame.assign(json_=[None if p is None else model(p) for p in frame[prompt]])

    return df.mapInPandas(run, kind).withColumn(out, F.from_json("json_", schema)).drop("json_")


def worst_confidence(c: Column) -> Column:
    """Aggregate: the worst of high, medium, low, review; null counts as medium, and so does no row."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, CONFIDENCE)), c), F.lit(2))
    return F.coalesce(F.get(F.array(*map(F.lit, CONFIDENCE)), (F.max(F.when(rank == 0, 2).otherwise(rank)) - 1).cast("int")), F.lit("medium"))


def combined(df: DataFrame, key: str) -> DataFrame:
    """key, worst confidence, sorted distinct methods by '+', and distinct evidence by line in order of pos."""
    return df.groupBy(key).agg(
        worst_confidence(F.col("confidence")).alias("confidence"),
        F.array_join(F.array_sort(F.collect_set("method")), "+").alias("methods"),
        F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "evidence"))), lambda x: x["evidence"])), "\n").alias("evidence"),
    )


STORE_KEYS = ("kind", "cik", "source_accession")


def saved(store: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """The store after results: verdicts survive equal payloads, a changed payload becomes pending with a note.

    store: keys, payload, edited, status, review_note, created_utc, updated_utc; results: keys and payload.
    """
    old = store.select(*STORE_KEYS, F.lit(True).alias("had_"), *[F.col(c).alias(f"{c}_old") for c in ("payload", "edited", "status", "review_note", "created_utc", "updated_utc")])
    both = old.join(results.select(*STORE_KEYS, F.lit(True).alias("got_"), F.col("payload").alias("new_")), [*STORE_KEYS], "full_outer")
    is_new = F.col("had_").isNull()
    changed = F.col("had_").isNotNull() & F.col("got_").isNotNull() & ~F.col("payload_old").eqNullSafe(F.col("new_"))
    return both.select(
        *STORE_KEYS,
        F.when(F.col("got_").isNull(), F.col("payload_old")).otherwise(F.col("new_")).alias("payload"),
        F.when(~changed, F.col("edited_old")).alias("edited"),
        F.when(is_new | changed, "pending").otherwise(F.col("status_old")).alias("status"),
        F.when(changed, F.concat(F.lit("superseded a result that was "), F.col("status_old"))).otherwise(F.col("review_note_old")).alias("review_note"),
        F.when(is_new, now).otherwise(F.col("created_utc_old")).alias("created_utc"),
        F.when(is_new | changed, now).otherwise(F.col("updated_utc_old")).alias("updated_utc"),
    )


def effective_payload() -> Column:
    """The edited payload where there is one."""
    return F.coalesce("edited", "payload")


def review_stats(store: DataFrame) -> DataFrame:
    """n_facts, n_companies, and facts by status."""
    return store.agg(F.count(F.lit(1)).alias("n_facts"), F.count_distinct("cik").alias("n_companies"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("pending", "approved", "rejected", "edited")])


STATUSES = ("pending", "approved", "rejected", "edited")


def review_status(c: Column) -> Column:
    """A known review status; anything else is pending."""
    return F.when(c.isin(*STATUSES), c).otherwise("pending")


def company_counts(store: DataFrame) -> DataFrame:
    """cik, n_facts and n_pending."""
    return store.groupBy("cik").agg(F.count(F.lit(1)).alias("n_facts"), F.count_if(F.col("status") == "pending").alias("n_pending"))


def recent_facts(store: DataFrame, k: int = 14) -> DataFrame:
    """The k facts that changed last; the limit is the feature."""
    return store.orderBy(F.desc("updated_utc"), "cik", "kind").limit(k)


def subsectors_of(df: DataFrame, sector: str) -> DataFrame:
    """df with the array of (code, name) of the subsectors of the sector code in a column."""
    table = data.industry_table(df.sparkSession).groupBy(F.col("sector_code").alias("sector_")).agg(F.array_sort(F.collect_set(F.struct(F.col("subsector_code").alias("code"), F.col("subsector").alias("name")))).alias("subsectors"))
    return df.join(F.broadcast(table), F.col(sector) == F.col("sector_"), "left").drop("sector_")  # 45 rows


RATIO_SCHEMA, SECTOR_SCHEMA = "ratio double, underlying string", "name string"


def ratio_evidence(text: Column, limit: int = 5) -> Column:
    """Up to limit sentences that a model may be asked about: of depositary shares, without holder counts and percentages."""
    found = F.filter(tx_sentences(text), lambda s: s.rlike("(?i)american depositar|\\bADSs?\\b") & s.rlike("(?i)represent|ratio") & ~s.rlike("(?i)holders? of record|%|per ?cent"))
    return F.slice(found, 1, limit)


def model_ratio(df: DataFrame, text: str, load: Callable[[], Callable[[str], str]]) -> DataFrame:
    """df with model_ratio and model_underlying that a model reads out of the candidate sentences; a ratio must lie between 0.0001 and 100.

    Texts without a candidate aren't shown to the model.
    """
    found = ratio_evidence(F.col(text))
    prompt = F.when(F.size(found) > 0, F.concat(F.lit("How many shares does one depositary share represent?\n"), F.array_join(found, "\n")))
    asked = with_model(df.withColumn("prompt_", prompt), "prompt_", "m_", load, RATIO_SCHEMA)
    good = F.col("m_.ratio").between(1e-4, 100)
    return asked.withColumn("model_ratio", F.when(good, F.col("m_.ratio"))).withColumn("model_underlying", F.when(good, F.col("m_.underlying"))).drop("prompt_", "m_")


def model_sector(df: DataFrame, text: str, load: Callable[[], Callable[[str], str]]) -> DataFrame:
    """df with sector_code and subsector_code that a model chooses by name.

    A first question is for the sector, a second for one of its subsectors; a
    sector of one subsector needs no second one.  A name that isn't offered gives null.
    """
    table = data.industry_table(df.sparkSession)
    sectors = table.select(F.col("sector_code"), F.lower("sector").alias("n_")).distinct()
    offered = ", ".join(dict.fromkeys(r[5] for r in data.industries()))
    first = with_model(df.withColumn("prompt_", F.when(F.col(text).isNotNull(), F.concat(F.lit(f"Sector, one of: {offered}\n"), text))), "prompt_", "m_", load, SECTOR_SCHEMA)
    first = first.withColumn("n_", F.lower(F.trim("m_.name"))).join(F.broadcast(sectors), "n_", "left").drop("n_", "m_", "prompt_")  # 45 rows
    held = subsectors_of(first, "sector_code")
    several = F.size("subsectors") > 1
    prompt = F.when(several, F.concat(F.lit("Subsector, one of: "), F.array_join(F.transform("subsectors", lambda s: s["name"]), ", "), F.lit("\n"), F.col(text)))
    second = with_model(held.withColumn("prompt_", prompt), "prompt_", "m_", load, SECTOR_SCHEMA)
    chosen = F.get(F.filter("subsectors", lambda s: F.lower(s["name"]) == F.lower(F.trim(F.col("m_.name")))), F.lit(0))["code"]
    only = F.when(F.size("subsectors") == 1, F.get("subsectors", F.lit(0))["code"])
    return second.withColumn("subsector_code", F.coalesce(only, chosen)).drop("subsectors", "prompt_", "m_")


def generated(df: DataFrame, prompt: str, out: str, load: Callable[[], Callable[[str], str]]) -> DataFrame:
    """df with a model's free answer to the prompt; null prompts have null answers."""
    return with_model(df, prompt, "answer_", lambda: _quoted_answers(load()), "a string").withColumn(out, F.col("answer_.a")).drop("answer_")


def _quoted_answers(model: Callable[[str], str]) -> Callable[[str], str]:
    return lambda question: json.dumps({"a": model(question)})


def headline(kind: Column, payload: Column) -> Column:
    """One line for a fact's JSON payload."""
    at = lambda k: F.get_json_object(payload, f"$.{k}")
    return F.when(kind == "icb", joined(at("sector"), at("industry"), by=" / ")).when(kind == "adr", F.coalesce(at("display"), F.lit("ratio not stated"))).when(kind == "voting", F.concat_ws(" = ", at("class_label"), at("votes_per_share"))).otherwise(payload)
