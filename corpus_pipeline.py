"""The corpus pipeline: language ID, quality rules, near-duplicates, packing.

Every stage works on all rows that the one before it kept; all but the last return the columns of documents.
A row is kept or dropped whole, with all its columns, whatever their names; packing returns the pieces of all documents that are left.
An empty table stays empty through all stages. Texts count whole, of any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelon.llm import langid, packing, rules, simhash
from allelon.llm.common import read_table
from allelon.llm.queries import BYTE_BPE, PIECES
from allelon.storage import store


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null or have no letters go. Repeated rows stay or go together."""
    return langid.keep_identified(docs, PIECES)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, by the verdict on their own row; repeated rows stay or go together, null and empty texts go."""
    return rules.keep_by_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (4-word shingles, fingerprints linked at 4 bits): that with the smallest id.

    Of rows that repeat an id and a text, one stays; null and empty texts are one group.
    """
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens; repeated rows and null ids are packed like any other."""
    found = packing.pack_documents(docs, BYTE_BPE)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: SQL has neither the tokenizers nor XXH64, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``; each stage but the last is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
