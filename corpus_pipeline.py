"""From raw documents to packed training sequences, in stages that each read what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality_model, quality_rules, simhash_dedup
from tidemark.llm.common import picked, table
from tidemark.session import materialize

#: The columns of documents, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learnt from the labels rejects go."""
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(picked(docs, *COLUMNS), model).where(f"score >= {quality_model.THRESHOLD}").select(*COLUMNS)


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or that the weighed rules reject, go."""
    return quality_rules.judge(picked(docs, *COLUMNS)).where("kept").select("record.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return simhash_dedup.keep_one(picked(docs, *COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, whole or in part, to their source's target."""
    return mixing.mixed_documents(picked(docs, *COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rule_filter),
    ("simhash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Hashes, the learnt model and token ids are beyond SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
