"""The corpus pipeline: STAGES in order, each over all that the one before kept.

Every stage takes nulls in any column, empty and very long texts, repeated rows,
extra columns and empty tables, which give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchwise.llm import decontam, mixing, neardup, quality, sharding
from branchwise.llm.common import delete, shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the base rules or the fences reject go; a null text has no words and goes. Repeated rows are judged alike."""
    return quality.judge(docs).where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays, once; texts without words are classes of their own."""
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, every repeated row of them; null and empty texts stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the fitted rates say; the likely good ones, and texts without words, at least once."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus in compacted shards, read back through the manifest; nulls, ties and repeats as they are."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("sharding", shards),
]
#: Sketches, MinHash, seeds and fitted rates have no SQL; tests/llm holds each operator against brute force, and the stages on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            delete(spark, f"{root}/{k - 1}-{STAGES[k - 1][0]}")  # nothing reads the stage before any more
    return docs
