"""The bounded samples that models are fitted to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm.common import cut, discard, held_out

_RANGE = 1 << 40


def least_hashes(rows: DataFrame, keys: list[str], *, limit: int) -> DataFrame:
    """``limit`` different rows, those whose keys' hashes are least; all if there are no more.

    About how many different keys there are tells from which hash on rows need
    not be looked at, so that what is made distinct and sorted is some times the limit.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(_RANGE))
    different = rows.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
    near = rows.where(place < int(8 * limit / different * _RANGE)) if different > 8 * limit else rows
    return near.distinct().orderBy(place, *keys).limit(limit)


def within(sample: DataFrame, keys: list[str], max_chars: int, text_col: str = "_text") -> DataFrame:
    """The rows of a sample, in the order of their keys' hashes, whose texts have ``max_chars`` characters in all; a text longer than that is passed over."""
    sizes = sample.select(F.xxhash64(*keys).alias("_h"), F.length(text_col).cast("bigint").alias("_n")).where(F.col("_n") <= max_chars)
    # Two numbers a row, of as many rows as the sample's limit.
    upto = sizes.withColumn("_sum", F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_h"))).where(F.col("_sum") <= max_chars).select("_h").distinct()
    return sample.withColumn("_h", F.xxhash64(*keys)).join(upto, "_h", "left_semi").drop("_h")


def labelled_sample(docs: DataFrame, labels: DataFrame, *, label: str, limit: int, max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_text, _label, _part``: at most ``limit`` labelled documents that are not held out, by the least hashes of their ids.

    ``_part`` is an even number from 0 to 99 for splits. Of labels that repeat
    an id the largest counts, of documents that do the one whose text has the
    least hash; null labels and ids don't. The limit bounds what is broadcast,
    as ids and labels only, and the sample.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    chosen = least_hashes(usable.select(F.col(id_col).alias("_id")), ["_id"], limit=limit)
    known = usable.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
    chosen = known.join(F.broadcast(chosen), "_id", "left_semi").groupBy("_id").agg(F.max("_label").alias("_label"))
    part = F.pmod(F.xxhash64(F.lit(7), "_id"), F.lit(100)).cast("int")
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    found = rows.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text"), "_text")).alias("_one"))
    found = cut(found.select("_id", F.coalesce("_one._text", F.lit("")).alias("_text"), "_label", part.alias("_part")), name="sample")
    kept = cut(within(found, ["_id"], max_chars).drop("_id"), name="sample")
    discard(found)
    return kept
