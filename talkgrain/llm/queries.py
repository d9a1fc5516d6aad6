"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm import decontamination, jaccard_join, license_scan, line_dedup, line_quality, merkle, mixing, pii, quality_rules, simhash, token_counts, toxicity, txlog
from talkgrain.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Most tokens of a document that is not over the limit.
TOKEN_LIMIT = 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: a directory of each source, of its languages, of a thousand ids, of a hundred each.

    Documents that speak of a licence stand in the directory of a thousand ids under a licence file's name; those whose text is one license what lies below.
    """
    docs = table(spark, sf_dir, "documents")
    above = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.expr("doc_id div 1000").cast("string"))
    name = F.col("doc_id").cast("string")
    path = F.when(F.lower("text").rlike("licen[cs]e"), F.concat_ws("/", above, F.concat(F.lit("LICENSE-"), name))).otherwise(F.concat_ws("/", above, F.expr("doc_id div 100").cast("string"), name))
    return license_scan.license_scan(docs.select("doc_id", "text", path.alias("path")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_quality.score(docs, line_quality.train(docs, table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines (from 0, comma-joined) of each document are later copies, and their words."""
    docs = table(spark, sf_dir, "documents")
    gone = line_dedup.deletions(docs).select(F.col("d").alias("_d"), F.col("v").alias("_v"), "lines", "n_words")
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash")).join(gone, (F.col("doc_id") == F.col("_d")) & (F.col("_hash") == F.col("_v")), "left")
    return rows.select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_deleted"), F.coalesce("n_words", F.lit(0)).alias("n_deleted_words"), F.coalesce(F.array_join("lines", ","), F.lit("")).alias("deleted_lines"))


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.ordered(mixing.plan(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "position", "again_position")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), budget=TOKEN_LIMIT, keep_prefixes=False)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, commits = txlog.resolve(txlog.document_log(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return txlog.digest(changes, txlog.epoch_states(changes, commits))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(merkle.manifest(merkle.document_leaves(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {"op3_near_duplicates": jaccard_join.ORACLE_SQL, "op6_decontaminate": decontamination.ORACLE_SQL, "op9_curriculum_mix": mixing.ORACLE_SQL, "op11_transaction_log": txlog.ORACLE_SQL, "op13_merkle_manifest": merkle.ORACLE_SQL}
