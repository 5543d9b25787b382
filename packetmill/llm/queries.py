"""One query per operator, over whole tables with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat_format, collision_counting, collocations, decontaminate, language_id, license_scan, near_hash, personal_data, quality_gam, retrieval_packing, sentence_spans, shard_packing, spelling_groups
from .base import read_table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, -7, whose texts hold the template's own control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(more)))


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.retrieval_packs(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_counting.collision_links(read_table(spark, sf_dir, "embeddings"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_gam.score(docs, quality_gam.fit(docs, read_table(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(read_table(spark, sf_dir, "documents"))


def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_hash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_packing.shard_rows(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_retrieval_packing": op2_retrieval_packing,
    "op3_collision_counting": op3_collision_counting,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_quality_gam": op5_quality_gam,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_personal_data": op8_personal_data,
    "op9_simhash_golay": op9_simhash_golay,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_collocations": op12_collocations,
    "op13_best_fit_shards": op13_best_fit_shards,
}

ORACLES: dict[str, str] = {"op1_chat_format": chat_format.ORACLE, "op10_decontamination": decontaminate.ORACLE, "op11_spelling_groups": spelling_groups.ORACLE, "op12_collocations": collocations.ORACLE}
