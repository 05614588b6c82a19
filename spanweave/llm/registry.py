"""The queries of this subpackage and the SQL that gives their results where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontaminate, languages, pages, prefixes, quality, repair, repeats, sharding, simhash, spotsigs, urls
from .common import table

#: The vocabulary of the token operators; any file of the same kind will do.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run(spark, sf_dir)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.run(spark, sf_dir)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.run(spark, sf_dir)


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.run(spark, sf_dir)


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.run(spark, sf_dir)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.run(spark, sf_dir)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(extra), TOKENIZER), TOKENIZER)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.run(spark, sf_dir)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.run(spark, sf_dir)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.run(spark, sf_dir)


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.run(spark, sf_dir)


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.run(spark, sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_urls": op2_urls,
    "op3_decontaminate": op3_decontaminate,
    "op4_spotsigs": op4_spotsigs,
    "op5_pages": op5_pages,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_suffixes": op8_suffixes,
    "op9_sharding": op9_sharding,
    "op10_bpe": op10_bpe,
    "op11_repair": op11_repair,
    "op12_prefixes": op12_prefixes,
    "op13_languages": op13_languages,
}
ORACLE_SQL: dict[str, str] = {
    "op2_urls": urls.verdict_sql(),
    "op3_decontaminate": decontaminate.PAIR_SQL,
    "op5_pages": pages.TEXT_SQL,
    "op7_chat": chat.DIGEST_SQL,
    "op9_sharding": sharding.placement_sql(),
    "op11_repair": repair.REPAIR_SQL,
    "op12_prefixes": prefixes.TREE_SQL,
}
