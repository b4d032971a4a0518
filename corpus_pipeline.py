"""A training-corpus pipeline over ``documents``.

Stages, in order: quality rules (rejected documents go), exact dedup (of equal
texts the largest ``doc_id`` stays), SimHash near-dedup (one document of each
component stays), mixing the sources to their target weights (documents appear
once per epoch, the last piece cut to the quota), BPE encoding and decoding.
Each stage's result is written as Parquet under the shared checkpoint folder
and read again as the next one's ``docs``; in ``run`` the last one's alone stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimsdq.llm import bpe, exact_dedup, mixing, quality, simhash
from claimsdq.llm.common import documents, scratch, staged

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, shingle=3, max_distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, weights=(1.0, 2.0, 3.0), max_repeat=3)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, str(public_tokenizers.path(TOKENIZER)), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: The last stage's ids cannot be computed in SQL; the stages are tested
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        with scratch(spark) as tables:       # what the stage wrote on its way goes with its predecessor's result
            docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
            own = tables.pop()
            if last:
                tables.append(last)
            last = own
    return docs
