"""Corpus pipeline over ``documents``: five stages, each calling one text
operator on everything that the stage before it kept.

1. quality rules: documents that the rules reject go
2. SimHash near-dedup: one document of each group stays
3. benchmark decontamination: documents that contain a benchmark item go
4. personal data: its spans are replaced in the texts
5. packing: the texts become sequences of 2048 tokens

Defined results: a null or empty text fails the quality rules, so none reaches
the later stages; a null id stays null and goes through all of them; of repeated
rows one is kept; very long texts are taken whole; extra columns, whatever their
names, come through to the last stage; an empty table gives no sequences.

Each stage but the last returns the columns of ``documents``. No stage is SQL
(trained rules, fingerprints, tokenizers), so there is no oracle; the tests
hold the rows against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillmart.llm import decontaminate, packing, pii, quality, simhash
from quillmart.llm.common import cut

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, in order, over the whole ``documents`` table. What a stage
    keeps is checkpointed, as the next one reads it more than once."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
