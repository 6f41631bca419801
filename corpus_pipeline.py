"""The corpus pipeline: documents in, encoded training rows out.

Each stage works on all that the stage before it kept; run() writes what a
stage returns to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filigree.llm import jaccard_join, mixing, quality, sentencepiece_codec, suffix_dedup
from filigree.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs, all columns, that the quality classifier keeps.

    Null and empty texts are rejected; rows without id are judged like others.
    Repeated rows stay or go together.  An empty table gives an empty one.
    """
    return quality.kept(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document of smallest id.

    Rows without id and documents without words are in no class and stay.
    Repeated rows of an id stay together.  An empty table gives an empty one.
    """
    return jaccard_join.unique(docs)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that stand earlier, in order of (doc_id, word), and n_chars counted anew.

    Rows without id, null and empty texts stay as they are; a document of which
    no word is left goes.  Repeated rows of an id are cut alike.  An empty table
    gives an empty one.
    """
    return suffix_dedup.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mixture; a document comes once for each epoch that takes it.

    Documents without a token (null, empty, blank) are never taken; null languages
    and sources are leaves named ''.  Rows of equal id have equal keys and are
    taken or left together.  An empty table gives an empty one.
    """
    return mixing.mix(docs, mixing.document_tree(), mixing.WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with ids, n_ids and round_trip.

    A null text has null ids, n_ids 0 and a null round_trip, an empty one has
    empty ids.  Every row stays, repeated ones repeated.  An empty table gives an
    empty one.
    """
    return sentencepiece_codec.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", no_repeated_passages),
    ("mixing", mixed),
    ("SentencePiece", encoded),
]
#: The classifier and the tokenizer are beyond SQL; tests hold every stage against a brute-force version, the last one against the tokenizer's library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
