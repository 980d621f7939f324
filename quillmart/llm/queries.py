"""The registered queries of the text operators: each applies one operator to
its whole table and derives the digest columns of its result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm import (chat, context_mixing, decontaminate, packing, pii, quality, repeated_windows,
                           sentence_spans, simhash, structure_repair, token_counts, toxicity, whitening)
from quillmart.llm.common import map_batches, text_rows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = pii.fit(docs)
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def make():
        def run(c: dict) -> dict:
            return {"doc_id": c["doc_id"], **dict(zip(names, zip(*(pii.digest(t, model) for t in c["text"]))))}

        return run

    return map_batches(text_rows(docs), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                              "base_sha256 string, spans string")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")), threshold=0.3)


def op4_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), words=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rules = quality.fit(docs, table(spark, sf, "labels"))
    return quality.judge(docs, rules).select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op5_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_windows.remove_repeats(table(spark, sf, "documents"), depth=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")),
        F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    more = more.select(F.lit(-7).cast("long").alias("conv_id"), F.col("t.turn").cast("long").alias("turn"),
                       F.col("t.role").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.windows(rows, public_tokenizers.path("byte_bpe_50k.json")))


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_spans.remove_repeats(table(spark, sf, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "n_found", "n_shingles", F.round("containment", 6).alias("containment"))


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    repair = structure_repair.Repair(structure_repair.damaged(rows))
    key = structure_repair.CONV
    found = repair.faults.join(structure_repair.digests(repair.edits), key)
    convs = rows.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return convs.join(found, key, "left").select(
        F.when(~F.col("none"), F.col("conv_id")).alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = whitening.blocks(table(spark, sf, "embeddings"))
    model = whitening.fit(rows, 8)
    return whitening.whitened(rows, model).withColumn("identity_error", F.lit(whitening.identity_error(rows, model)))


def op13_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return context_mixing.score(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_structure_repair": op11_structure_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_lm_scoring": op13_lm_scoring,
}

# Words as ``common.words_of`` has them: lower case, punctuation as white space.
_WORDS = r"""regexp_extract_all(regexp_replace(lower(text),
    '[!-/:-@\[-`{-~\x{a1}\x{a7}\x{ab}\x{b7}\x{bb}\x{bf}\x{2010}-\x{2027}\x{2030}-\x{205e}]', ' ', 'g'), '\S+')"""


def _shingles(table: str, key: str) -> str:
    """Distinct runs of five words, or all words of a shorter text."""
    return f"""(SELECT DISTINCT k, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT {key} AS k, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL) t,
             unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) r(i))"""


ORACLE: dict[str, str] = {
    "op8_benchmark_decontamination": f"""
WITH of_items AS {_shingles('benchmark', 'item_id')}, of_docs AS {_shingles('documents', 'doc_id')},
sizes AS (SELECT k, count(*) AS n FROM of_items GROUP BY k),
found AS (SELECT d.k AS doc_id, i.k AS item_id, count(*) AS n_found FROM of_docs d JOIN of_items i USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_found, n AS n_shingles, round(n_found / n, 6) AS containment
FROM found JOIN sizes ON k = item_id WHERE n_found >= 0.8 * n""",
}
