"""The registered queries of this subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.llm import (bpe, chat, divergence, exact_dedup, licenses, mixing, pii, quality, quality_fm,
                          repair, shard, simhash, suffix_dedup)
from claimsdq.llm.common import documents

SHARDS = 40
TOKENIZER = "word_bpe_49k.json"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_distance=2)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir), keep="largest")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(documents(spark, sf_dir), weights=(1.0, 2.0, 3.0), max_repeat=3) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_records(documents(spark, sf_dir), [1.0] * SHARDS)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), length=100)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


def op8_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its last answer swapped; loss
    spans as text (start:end, comma-joined)."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = chat.format_preferences(chat.pairs_by_last_answer(turns))
    for c in ("chosen_loss", "rejected_loss"):
        pairs = pairs.withColumn(c, F.array_join(F.transform(
            c, lambda s: F.concat_ws(":", s["start"], s["end"])), ","))
    return pairs


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), str(public_tokenizers.path(TOKENIZER)))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.classify(docs, quality_fm.train(docs, labels, "quality"), least=0.7)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir), min_df=3, top_terms=200)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations damaged by rule, repaired, and the figures of each."""
    turns, copies = repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.figures(repair.repair(turns, copies))


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_exact_dedup, op3_mixing, op4_sharding, op5_license_scan, op6_suffix_dedup,
        op7_pii, op8_preferences, op9_quality_rules, op10_bpe, op11_quality_classifier,
        op12_source_divergence, op13_conversation_repair)}
