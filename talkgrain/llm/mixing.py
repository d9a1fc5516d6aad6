"""Mixing sources to target weights along a time-varying curriculum.

Sources share ``share`` times all words by their weights; none gets more than
``cap`` times its own words, and what it can't use goes to the others by
weight (the water level of the targets is found in one ordered pass over the
sources). Within a source, documents come in the order of a hash; each source
is read from the start again until its target is reached, and the last
document of a source is cut at the target.

A source's weight changes over training time ``t`` from 0 to 1 as ``1 + slope
* (2 t - 1)``. Its integral, times the target, is the demand for the source's
words up to ``t``; inverting it at the words that precede a document gives the
document's training position, and the mix is range-sorted by position.

All of it is DataFrame operations. A running sum over a source is taken in two
levels (hash buckets of a source, then documents of a bucket), so that no task
holds a source, however much of the rows it has.

Null texts have no words; a null source is a source of its own, the last one;
empty documents and documents beyond a target are taken 0 times; rows that
share an id, null ids too, are documents of their own, in the order of their
texts' hashes; rows alike in id, source and text are interchangeable. An empty
table gives an empty mix. Further columns stay, whatever their names: where one
of the mix's own columns has the name of one of the input's, the mix's gets
underscores behind it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm.common import WORD_PATTERN, cut, free_name, temporary


@dataclass(frozen=True)
class Mix:
    """``weights`` and ``slopes`` repeat over the sources in their order; slopes lie between -1 and 1."""

    weights: tuple[int, ...] = (5, 2, 1)
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5)
    share: float = 1.5
    cap: float = 2
    bucket_bits: int = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def order_hash(doc_id: Column) -> Column:
    """60 bits of the id's md5; null ids count as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row a source: ``_source, source_size, target, _slope``; from ``_source, _size`` of every document."""
    sums = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    cycle = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("_place") % len(values) + 1).cast("int"))
    level = W.orderBy("_full_at", "_place")
    every = W.partitionBy(F.lit(0))
    sums = sums.withColumn("_place", place).withColumn("_weight", cycle(mix.weights)).withColumn("_slope", cycle(mix.slopes))
    sums = sums.withColumn("_most", mix.cap * F.col("source_size")).withColumn("_full_at", F.col("_most") / F.col("_weight"))
    sums = (
        sums.withColumn("_wanted", F.sum("source_size").over(every) * F.lit(float(mix.share)))
        .withColumn("_used", F.coalesce(F.sum("_most").over(level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_weights", F.sum("_weight").over(level.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", (F.col("_wanted") - F.col("_used")) / F.col("_weights"))
    )
    first = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_place", "_level"))).over(every)["_level"]
    target = F.least(F.col("_most").cast("double"), F.coalesce(first, F.lit(float("inf"))) * F.col("_weight"))
    return sums.select("_source", "source_size", target.alias("target"), F.col("_slope").cast("double").alias("_slope"))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """``_id, _source, _size, _text_hash`` of every document, and further columns."""
    text = F.col(text_col).cast("string")
    return cut(docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"), n_words(text).alias("_size"), F.xxhash64(text).alias("_text_hash"), *more), name="sizes")


def plan(docs: DataFrame, mix: Mix | None = None, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: ``id_col, size, source_size, target, taken, position, again_position, passes``.

    ``passes`` has, for each time the document is taken, which time it is
    (``copy``, from 1), the words taken and the position, from 0 to 1; the first
    two positions are columns of their own, null where there is no such pass.
    """
    with temporary():
        planned = _planned(_sizes(docs, id_col, text_col, source_col), mix or Mix())
        at = lambda k: F.get(F.filter("passes", lambda x: x["copy"] == k), 0)["position"]
        planned = planned.select(F.col("_id").alias(id_col), "size", "source_size", "target", "taken", at(1).alias("position"), at(2).alias("again_position"), "passes")
        return cut(planned, name="plan", keep=True)


def _planned(sized: DataFrame, mix: Mix) -> DataFrame:
    """``size, source_size, target, taken, passes`` beside the columns of ``sized``: ``_id, _source, _size, _text_hash`` and others."""
    sources = source_targets(sized, mix)
    # Documents without an id are spread over the buckets by their texts.
    keyed = sized.withColumn("_hash", F.when(F.col("_id").isNull(), order_hash(F.col("_text_hash"))).otherwise(order_hash(F.col("_id"))))
    keyed = keyed.withColumn("_bucket", F.shiftright("_hash", 60 - mix.bucket_bits))
    buckets = keyed.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_held"))
    before = F.sum("_held").over(W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    buckets = buckets.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    buckets = buckets.join(sources.withColumnRenamed("_source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    inside = F.sum("_size").over(W.partitionBy("_source", "_bucket").orderBy("_hash", "_id", "_size", "_text_hash").rowsBetween(W.unboundedPreceding, -1))
    rows = keyed.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(buckets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    rows = rows.withColumn("_at", F.col("_before") + F.col("_inside")).withColumn("_wanted", F.round("target").cast("bigint"))

    def passed(k: int) -> Column:
        offset = k * F.col("source_size") + F.col("_at")
        words = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_wanted") - offset))
        # t solves (1 - slope) t + slope t^2 = the share of the source's demand that comes before.
        share = (offset + words / 2) / F.col("target")
        flat = 1 - F.col("_slope")
        position = F.least(F.lit(1.0), 2 * share / (flat + F.sqrt(flat * flat + 4 * F.col("_slope") * share)))
        return F.struct(F.lit(k + 1).alias("copy"), words.alias("words"), F.when(words > 0, position).alias("position"))

    rows = rows.withColumn("passes", F.filter(F.array(*map(passed, range(math.ceil(mix.cap)))), lambda x: x["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda n, x: n + x["words"])
    return rows.select(*sized.columns, F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"), "passes")


def ordered(planned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The plan, range-sorted by training position; documents that are not taken come last."""
    return planned.orderBy(F.col("position").asc_nulls_last(), id_col)


def materialised(docs: DataFrame, mix: Mix | None = None, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: a row for each time a document is taken, range-sorted by ``position``.

    The columns of ``docs``, ``copy`` (1 or 2), ``taken_words`` and
    ``position``. Documents are numbered in one written table, and the plan is
    joined by number, so that ids may be null or repeat. A document cut at its
    source's target keeps its whole text, and ``taken_words`` says where to cut
    it.
    """
    names = docs.columns
    row, copy, taken, position = (free_name(names, c) for c in ("_row", "copy", "taken_words", "position"))
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), name="numbered", keep=True)
    with temporary():
        sized = _sizes(numbered, id_col, text_col, source_col, F.col(row).alias("_row"))
        slim = _planned(sized, mix or Mix()).select(F.col("_row").alias(row), F.explode("passes").alias("_pass"))
        slim = cut(slim.select(row, F.col("_pass.copy").alias(copy), F.col("_pass.words").alias(taken), F.col("_pass.position").alias(position)), name="passes", keep=True)
    return numbered.join(slim, row).drop(row).orderBy(position, id_col, copy)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         [-0.5::DOUBLE, 0::DOUBLE, 0.5::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS slope,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source),
f AS (SELECT *, 2 * source_size AS most, 2 * source_size / weight::DOUBLE AS full_at FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - COALESCE(sum(most) OVER (ORDER BY full_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY full_at, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM f),
w AS (SELECT arg_min(lev, (full_at, place)) AS level FROM l WHERE lev <= full_at),
t AS (SELECT source, source_size, slope, least(most::DOUBLE, level * weight) AS target FROM l, w),
c AS (
  SELECT d.*, t.source_size, t.target, round(target)::BIGINT AS wanted, t.slope,
         COALESCE(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, greatest(0, least(size, wanted - earlier)) AS one, greatest(0, least(size, wanted - source_size - earlier)) AS two
  FROM c),
q AS (
  SELECT *, (earlier + one / 2::DOUBLE) / target AS x, (source_size + earlier + two / 2::DOUBLE) / target AS y
  FROM p)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken,
       CASE WHEN one > 0 THEN least(1::DOUBLE, 2 * x / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * x))) END AS position,
       CASE WHEN two > 0 THEN least(1::DOUBLE, 2 * y / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * y))) END AS again_position
FROM q
"""
