"""Corpus pipeline: from raw documents to packed training sequences.

STAGES lists the stages in order. Each takes (spark, docs, sf_dir) and returns a frame,
which is written as Parquet and read again as the next stage's docs. All but the last
return the columns of `documents`; each works on everything its predecessor kept.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemark.llm import decontaminate, ngram_join, packing, toxicity
from telemark.llm.queries import table
from telemark.llm.tables import stored


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the label table, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.corpus_chain(docs, table(spark, sf_dir, "labels")))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return ngram_join.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("ngram_jaccard_join", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("best_fit_packing", pack),
]

# SQL can express neither the trained model nor the order-dependent packing;
# tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
