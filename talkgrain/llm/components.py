"""Connected components of a graph of edges, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import cut, discard


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges(a, b)``: the least node it reaches.

    Each round takes the least label among a node's neighbours and then the
    label of that label, so labels travel twice as far each round; every round
    is written to the shared folder. Self-loops, nulls and repeated edges
    change nothing.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name="edges")
    written = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), name="labels")
    labels = written.select("node", "component")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_least"))
        told = labels.join(near, "node").select("node", "component", F.least("component", "_least").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("component").alias("_far"))
        new = cut(told.join(jump, "_new").select("node", F.least("_new", "_far").alias("component"), (F.least("_new", "_far") < F.col("component")).alias("_changed")), name="labels")
        discard(written)
        written, labels = new, new.select("node", "component")
        if new.where("_changed").isEmpty():
            discard(both)
            return labels
