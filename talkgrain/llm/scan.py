"""Running summaries along places that are integers, block by block and level by level.

A row's ``before`` is what all rows of its keys at lower places come to. Rows
are summed up in blocks of ``1 << BITS`` places, the blocks' totals are scanned in the
same way, and what comes before a block goes down to its rows. So no window is
longer than a block, however many rows one key has, and nothing passes through
the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm.common import cut

BITS = 10
#: Rows that a sorted partition of ``ranked`` is to have.
SORTED_ROWS = 1 << 14


@dataclass(frozen=True)
class Summary:
    """How rows add up: ``running(rows, keys)`` adds ``before`` within the keys, ``joined`` adds two neighbouring summaries."""

    running: Callable[[DataFrame, list[str]], DataFrame]
    joined: Callable[[Column, Column], Column]


def _earlier(keys: list[str]):
    return W.partitionBy(*keys).orderBy("place").rowsBetween(W.unboundedPreceding, -1)


def sums(*fields: str) -> Summary:
    """``value`` is a struct of numbers, which are added up."""

    def running(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.withColumn("before", F.struct(*[F.coalesce(F.sum(F.col("value")[f]).over(_earlier(keys)), F.lit(0)).cast("bigint").alias(f) for f in fields]))

    return Summary(running, lambda a, b: F.struct(*[(a[f] + b[f]).cast("bigint").alias(f) for f in fields]))


def latest() -> Summary:
    """The last ``value`` that is not null."""
    return Summary(lambda rows, keys: rows.withColumn("before", F.last("value", ignorenulls=True).over(_earlier(keys))), lambda a, b: F.coalesce(b, a))


def scan(rows: DataFrame, keys: list[str], span: int, how: Summary, bits: int = BITS) -> DataFrame:
    """``rows`` with ``before``; ``place`` is unique by the keys, which are not null, and its values lie within ``span``."""
    if span <= 1 << bits:
        return how.running(rows, keys)
    inner = how.running(rows.withColumn("_block", F.shiftright("place", bits)), [*keys, "_block"]).withColumnRenamed("before", "_inner")
    inner = cut(inner, name="scan")
    blocks = inner.groupBy(*keys, F.col("_block").alias("place")).agg(F.max_by(how.joined(F.col("_inner"), F.col("value")), F.col("place")).alias("value"))
    outer = scan(blocks, keys, (span >> bits) + 2, how, bits).select(*keys, F.col("place").alias("_block"), F.col("before").alias("_outer"))
    return inner.join(outer, [*keys, "_block"]).withColumn("before", how.joined(F.col("_outer"), F.col("_inner"))).drop("_block", "_inner", "_outer")


def ranked(rows: DataFrame, keys: list[str], order: list[str], count: int, bits: int = BITS) -> DataFrame:
    """``rows`` with ``pos``, their places from 0 within the keys (not null) by ``order``; ``count`` rows or about so many.

    A range sort deals rows out in partitions; the rows of a key in a partition
    have neighbouring numbers there, and a scan says how many came before.
    """
    parts = max(1, -(-count // SORTED_ROWS))
    numbered = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_number", F.monotonically_increasing_id())
    numbered = cut(numbered, name="sorted")
    part = F.shiftright("_number", 33)
    runs = numbered.groupBy(*keys, part.alias("place")).agg(F.struct(F.count("*").alias("n")).alias("value"), F.min("_number").alias("_first"))
    starts = scan(runs, keys, parts, sums("n"), bits).select(*keys, F.col("place").alias("_part"), "_first", F.col("before.n").alias("_before"))
    placed = numbered.withColumn("_part", part).join(starts, [*keys, "_part"])
    return placed.select(*rows.columns, (F.col("_before") + F.col("_number") - F.col("_first")).alias("pos"))
