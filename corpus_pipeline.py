"""A corpus pipeline of the training-data operators: from raw documents to an ordered training mix.

Each stage gets what the one before kept, as a table with the columns of
``documents``; ``run`` applies them one after the other. No stage drops a row
for any reason but its own rule: quality rules reject documents, line dedup
deletes later copies of repeated line runs (and documents that are nothing
else), the similarity join keeps one document of each group, decontamination
cuts benchmark passages out (and drops documents that are mostly such
passages), and the mix decides how often, and when, each document is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm import decontamination, jaccard_join, line_dedup, mixing, quality_rules

#: Near-duplicate stages take five words a shingle and a similarity of 0.8.
SIMILARITY = jaccard_join.Similarity(width=5, numerator=4, denominator=5)


def _measured(docs: DataFrame) -> DataFrame:
    """The length of an edited text again."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    edited = line_dedup.dedup_lines(docs)
    return _measured(edited.where(F.col("text").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, SIMILARITY)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontamination.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialised(docs)


STAGES = [
    ("quality_rules", reject_low_quality),
    ("line_dedup", delete_repeated_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", remove_benchmark_passages),
    ("mixing", mix_sources),
]

#: Compression ratios are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
