"""From raw documents to packed training sequences.

Four stages, each over all documents that the stage before kept: quality rules drop documents, one document
of each group of near copies stays (fingerprints of four-word shingles at most four bits apart), personal
data is replaced in the texts, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import pii, quality, simhash
from tidewell.llm.common import table
from tidewell.llm.queries import packed_pieces
from tidewell.session import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("personal_data", redact),
    ("packing", pack),
]

#: SQL can express neither the forest nor the fingerprints; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
