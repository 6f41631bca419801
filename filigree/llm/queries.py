"""One query for each training-data operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filigree.llm import chat_format, exact_search, html_extract, jaccard_join, language, mixing, permutation_index, quality, sentencepiece_codec, suffix_dedup
from filigree.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, round_trip of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs).drop("text")


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the target mixture, once for each epoch that takes them."""
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


ORACLES["op10_mixing"] = f"with {mixing.mixed_sql()} select * from mixed"


@_query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, language and confidence of all documents."""
    docs = table(spark, sf_dir, "documents")
    return language.tag(docs.select("doc_id", "text"), language.fit(docs)).drop("text")


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, quality_score and keep of all documents."""
    return quality.classify(table(spark, sf_dir, "documents"))


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id and n_links of every document that is linked with another one."""
    return jaccard_join.document_links(table(spark, sf_dir, "documents"))


ORACLES["op3_jaccard_join"] = jaccard_join.links_sql()


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of words that repeat earlier passages of 50 words or more, by document."""
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


ORACLES["op4_suffix_dedup"] = suffix_dedup.repeats_sql()


@_query
def op5_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest others, among all embeddings, of every embedding whose id is divisible by 50."""
    return exact_search.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op5_exact_search"] = exact_search.top_k_sql()


@_query
def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About the ten nearest others, among all embeddings, of every embedding whose id is divisible by 50."""
    return permutation_index.search(table(spark, sf_dir, "embeddings"))


@_query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content region of every page, with weights from the labelled pages."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


ORACLES["op2_html_extraction"] = html_extract.extract_sql()


@_query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as one text that parses back to its turns."""
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


ORACLES["op9_chat_formatting"] = chat_format.format_sql()
