"""The registered query of each text operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    exact_topk,
    fill_in_middle,
    html_text,
    mixing,
    oracles,
    packing,
    quality_model,
    quality_rules,
    secret_scan,
    shards,
    simhash_dedup,
    spelling_variants,
    token_counts,
    token_shards,
)
from tidemark.llm.common import table

#: Tokens beyond which a document does not fit one training sequence.
TOKEN_LIMIT = 2048


def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def html_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(shards.shard_documents(table(spark, sf_dir, "documents")))


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), kept=["doc_id"]).select(
        F.col("record.doc_id").cast("long").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def token_shards_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.digest(spark, token_shards.write_shards(table(spark, sf_dir, "documents")))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def quality_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def fill_in_middle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def secret_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def queries() -> dict:
    return {
        "op1_token_counts": token_count_query,
        "op2_html_text": html_text_query,
        "op3_simhash_near_dedup": simhash_query,
        "op4_sharding": sharding_query,
        "op5_quality_rules": quality_rules_query,
        "op6_exact_topk": topk_query,
        "op7_token_shards": token_shards_query,
        "op8_packing": packing_query,
        "op9_mixing": mixing_query,
        "op10_quality_classifier": quality_model_query,
        "op11_spelling_variants": spelling_query,
        "op12_fill_in_middle": fill_in_middle_query,
        "op13_secret_scan": secret_scan_query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
