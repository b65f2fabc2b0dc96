"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, token ids.

Each stage takes the documents its predecessor kept and returns documents; the last
returns the ids' digests per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tremorlake.llm import bag_minhash, bpe, mixing, quality
from tremorlake.llm import line_dedup as lines
from tremorlake.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.line_dedup(docs, removed="__removed").drop("__removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.tempered_mix(docs, copy="__copy", order="__order").drop("__copy", "__order")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, "source")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing_stage),
    ("bpe", encoding),
]

# Near-duplicate stages can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
