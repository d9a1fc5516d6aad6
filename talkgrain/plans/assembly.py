"""Records from planned turns and a table of utterances, by set-wise attempts.

Each turn of a plan takes an utterance of its pool. All turns of an attempt
take theirs at once: the turns that have none yet, numbered within their pool, meet the utterances that
nobody has taken, numbered alike. A gate says which ones do; the turns of the others try
again, at most a fixed number of times. A record is one whose turns all have an
utterance; of the others the first turn without one and its error go to a side channel.
No text is made here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.sources.jsonl import scratch

NO_UTTERANCE = "no_utterance_left"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "_k") -> DataFrame:
    """``rows`` with their numbers from 0 within the keys: a range sort, and for each key what earlier ranges hold, so that no key is one task's."""
    ranged = _kept(rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", 33)
    # A row for each key and range.
    runs = ranged.groupBy(*keys, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(*keys, "_part", (before - F.col("_first")).alias("_shift"))
    return ranged.withColumn("_part", part).join(starts, [*keys, "_part"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(name))


def assemble(plans: DataFrame, utterances: DataFrame, gate: Callable[[Column], Column], *, attempts: int = 3) -> DataFrame:
    """``plans`` (``record_id, turn_id, pool`` and what the gate reads) with ``utterance``, ``attempt`` (from 1) and ``error``.

    ``utterances``: ``pool, ord, text``. ``gate`` gives the error of a text for a plan's row, or
    null. A turn that no attempt served keeps its last error.
    """
    columns = plans.columns
    said = _kept(numbered(utterances.select("pool", "ord", "text"), ["pool"], ["ord"], "_u"), "said")
    used = None
    left, served = plans, []
    for attempt in range(1, attempts + 1):
        turns = numbered(left, ["pool"], ["record_id", "turn_id"])
        if used is not None:
            turns = turns.join(used, "pool", "left").withColumn("_u", F.col("_k") + F.coalesce("_used", F.lit(0))).drop("_used")
        else:
            turns = turns.withColumn("_u", F.col("_k"))
        tried = turns.join(said, ["pool", "_u"], "left")
        error = F.when(F.col("text").isNull(), NO_UTTERANCE).otherwise(gate(F.col("text")))
        tried = _kept(tried.select(*columns, "text", error.alias("error")), "tried")
        served.append(tried.where("error IS NULL").select(*columns, F.col("text").alias("utterance"), F.lit(attempt).alias("attempt"), F.col("error")))
        left = tried.where("error IS NOT NULL").select(*columns)
        counts = tried.groupBy("pool").agg(F.count("*").alias("_used"))
        used = counts if used is None else used.unionByName(counts).groupBy("pool").agg(F.sum("_used").alias("_used"))
        last = tried
    out = last.where("error IS NOT NULL").select(*columns, F.lit(None).cast("string").alias("utterance"), F.lit(attempts).alias("attempt"), "error")
    for part in served:
        out = out.unionByName(part)
    return out


def records_and_errors(turns: DataFrame, *fields: str) -> tuple[DataFrame, DataFrame]:
    """Of assembled turns: whole records, ``record_id, dialogue``, and ``record_id, turn_id, attempts, error`` of those that are not."""
    turn = F.struct("turn_id", *fields, "utterance")
    each = turns.groupBy("record_id").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"), F.min(F.when(F.col("error").isNotNull(), F.struct("turn_id", "attempt", "error"))).alias("_e"))
    return each.where("_e IS NULL").select("record_id", "dialogue"), each.where("_e IS NOT NULL").select("record_id", "_e.turn_id", F.col("_e.attempt").alias("attempts"), "_e.error")
