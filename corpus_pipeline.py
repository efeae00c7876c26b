"""From raw documents to packed sequences, in stages that are written and read again.

Stages: quality rules, exact dedup, near-dedup, mixing to target weights, packing.
Each takes (spark, docs, sf_dir) and works on all that the one before kept; all but
the last return the columns of documents. ``ORACLE_SQL`` is None: the line
field's decoding, signatures and the linear program have no SQL form; tests hold
the stages against brute force instead.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from equilibra.llm import dedup, mixing, neardup, packing, quality
from equilibra.llm._work import run_dir, saved, table
from equilibra.llm.queries import tokenizer

#: No document twice, and nine tenths of the tokens that arrive.
MIX = replace(mixing.PRODUCTION, share=0.9, epochs=1)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
