"""The registered queries of this package: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import (
    byte_pairs, decontamination, divergence, kneser_ney, minhash, packing, pages, pii, quality, secrets, spelling, tokens, toxicity,
)
from shelfwise.llm.common import held_out, read, vocabulary


def op1_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, base, "documents"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        "base_sha256",
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op2_robust_outliers(spark: SparkSession, base: str) -> DataFrame:
    return quality.judge(read(spark, base, "documents"))


def op3_scored_main_text(spark: SparkSession, base: str) -> DataFrame:
    return pages.extract(read(spark, base, "pages"))


def op4_template_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return decontamination.contaminated(read(spark, base, "documents"), read(spark, base, "benchmark"))


def op5_retrieval_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(read(spark, base, "documents"), vocabulary("word_bpe_49k.json"))


def op6_subword_toxicity(spark: SparkSession, base: str) -> DataFrame:
    held = held_out("doc_id", 3, 1)
    scored = toxicity.toxicity(read(spark, base, "documents"), read(spark, base, "labels"), ~held)
    return scored.withColumn("held_out", held)


def op7_weak_supervision_pii(spark: SparkSession, base: str) -> DataFrame:
    found = pii.find_personal(read(spark, base, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op8_transducer_tokens(spark: SparkSession, base: str) -> DataFrame:
    return tokens.count_tokens(read(spark, base, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_kneser_ney(spark: SparkSession, base: str) -> DataFrame:
    held = held_out("doc_id", 7, 2)
    scored = kneser_ney.perplexity(read(spark, base, "documents"), ~held)
    return scored.withColumn("held_out", held)


def op10_circulant_minhash(spark: SparkSession, base: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, base, "documents"))


def op11_distinct_word_bpe(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_50k.tiktoken")
    return byte_pairs.round_trip(read(spark, base, "documents"), path, public_tokenizers.PATTERN)


def op12_source_divergence(spark: SparkSession, base: str) -> DataFrame:
    return divergence.audit(read(spark, base, "documents"))


def op13_spelling_tiles(spark: SparkSession, base: str) -> DataFrame:
    return spelling.variants(read(spark, base, "documents"))


def queries() -> dict:
    own = {name: query for name, query in globals().items() if name.startswith("op")}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the result; tests hold the others against brute force."""
    return {"op12_source_divergence": divergence.SQL, "op13_spelling_tiles": spelling.SQL}
