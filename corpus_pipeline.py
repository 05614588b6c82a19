"""Corpus pipeline over ``documents``: five stages, each on all that the one before kept.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of each group of linked SimHash fingerprints the smallest doc_id stays.
3. repeated_passages: byte strings that repeat anywhere go from the texts.
4. decontamination: documents that contain a benchmark item go.
5. tokens: each text encoded and decoded; one row of digests for each document.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanweave.llm import bpe, decontaminate, quality, repeats, simhash
from spanweave.llm.common import cut, forget, table
from spanweave.llm.registry import TOKENIZER


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def strip_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.strip_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, TOKENIZER)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_passages", strip_repeated_passages),
    ("decontamination", drop_contaminated),
    ("tokens", encode),
]

#: XXH64 fingerprints and the fitted classifier have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; what each but the last keeps is written as a table for
    the next, and deleted when the next one's is written.

    Null and empty texts, repeated rows and further columns are each stage's matter: see their
    functions.  Empty table: empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
