"""The corpus pipeline: toxicity, quality, near-duplicates, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import packing, quality, simhash, toxicity
from roomledger.llm.common import read
from roomledger.llm.queries import (
    PACKING_TOKENIZER,
    QUALITY_CUT,
    SHINGLE_WORDS,
    TOXICITY_CUT,
    quality_held_out,
    toxicity_held_out,
)
from roomledger.sources.scratch import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored as toxic go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), toxicity_held_out())
    scored = toxicity.score(docs, model, carry=COLUMNS)
    return scored.where(scored["toxicity"] < TOXICITY_CUT).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored below the quality cut go."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), quality_held_out())
    scored = quality.score(docs, model, carry=COLUMNS)
    return scored.where(scored["quality"] >= QUALITY_CUT).select(*COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    prints = simhash.fingerprints(docs, SHINGLE_WORDS, carry=COLUMNS)
    return simhash.one_of_each_group(prints).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents in their sequences."""
    return packing.pack(docs, PACKING_TOKENIZER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]

# Fitted models cannot be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result but the last is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
