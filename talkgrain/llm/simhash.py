"""SimHash near-duplicates: 64-bit fingerprints of texts, linked where few bits differ, compared tile by tile.

A fingerprint bit is set where over half of the hashes of a text's word
shingles (repeats count) have it. Equal fingerprints are one node. Nodes are put
into classes by the population counts of the four quarters of their bits: two
nodes differ in at least as many bits as the counts of their quarters differ in
sum, so classes that are further apart than the radius have no link between them
and are skipped. A class is dealt into tiles of a bounded size by a hash; each
pair of tiles that is left is compared in full, by numpy's exclusive-or and bit
counts.

A pair of tiles gives no list of its links but, for every node that has one, the
least node it reaches within the pair: at most as many rows as the two tiles
have nodes. Connected components over these are those over all links.

Texts without words have fingerprint 0 and link like any other. A null text
counts as empty. A null id takes no part and has a null component. Rows that
repeat an id are documents of their own with one name. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import cut, map_arrow, temporary, texts_of
from talkgrain.llm.components import components

#: Nodes that a tile is to have.
TILE = 2048
SEED = 42
_BLOCK = 1 << 14


def fingerprint(text: bytes, width: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        m = min(_BLOCK, n - k)
        spans = zip(starts[k : k + m].tolist(), ends[k + width - 1 : k + width - 1 + m].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, m)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp bigint`` of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, width) for t in texts_of(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return map_arrow(rows, run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp bigint")


def _steps(radius: int) -> list[int]:
    """From a class to those within the radius that do not come before it; a class is four counts of 0 to 16, in base 32."""
    moves = [m for m in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, m)) <= radius]
    return sorted(s for s in (a + 32 * b + 1024 * c + 32768 * d for a, b, c, d in moves) if s >= 0)


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least of ``n`` nodes that each one reaches over the links ``a`` to ``b``."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def tile_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the nodes of two tiles that have a link to the other one, pairs ``(node, least node it reaches)``."""
    i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
    nodes, place = np.unique(np.concatenate((left, right)), return_inverse=True)
    found = roots(place[i], place[len(left) + j], len(nodes))
    moved = np.flatnonzero(found != np.arange(len(nodes)))
    return nodes[moved], nodes[found[moved]]


def linked(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """``a, b``: enough edges between the distinct fingerprints ``fp`` to connect all that links of at most ``radius`` bits connect."""
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    placed = nodes.select("fp", sum((q * (32**k) for k, q in enumerate(quarters)), F.lit(0)).alias("class"))
    # One row for each class that occurs, of 17^4 that can.
    sizes = placed.groupBy("class").agg(F.expr(f"count(*) div {tile} + 1").alias("_parts"))
    tiles = placed.join(sizes, "class").groupBy("class", F.expr("pmod(xxhash64(fp), _parts)").alias("part")).agg(F.collect_list("fp").alias("fps"))
    tiles = cut(tiles, name="tiles")
    from_here = tiles.select(F.explode(F.array(*[F.col("class") + F.lit(s) for s in _steps(radius)])).alias("_to"), "class", "part", "fps")
    there = tiles.select(F.col("class").alias("_to"), F.col("part").alias("_part"), F.col("fps").alias("_fps"))
    pairs = from_here.join(there, "_to").where("class <> _to OR part <= _part").select("fps", "_fps")

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = [(np.asarray(c.values.to_numpy(zero_copy_only=False)).view(np.uint64), c.offsets.to_numpy()) for c in batch.columns]
        found = [tile_links(*(values[at[k] : at[k + 1]] for values, at in sides), radius) for k in range(batch.num_rows)]
        a, b = (np.concatenate([np.empty(0, np.uint64), *(f[s] for f in found)]).view(np.int64) for s in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return cut(map_arrow(pairs, compare, "a bigint, b bigint").distinct(), name="links")


def simhash(docs: DataFrame, width: int = 3, radius: int = 2, *, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits)``, component_id`` of every row."""
    with temporary():
        told = cut(fingerprints(docs, width, id_col=id_col, text_col=text_col).toDF("_id", "fp"), name="fingerprints")
        nodes = cut(told.where("_id IS NOT NULL").groupBy("fp").agg(F.min("_id").alias("least")), name="nodes")
        reached = components(linked(nodes.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
        placed = nodes.join(reached, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
        names = placed.groupBy("component").agg(F.min("least").alias("_name"))
        named = placed.join(names, "component").select("fp", "_name")
        found = told.join(named, "fp", "left").select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("_id").isNotNull(), F.col("_name")).alias("component_id"))
        return cut(found, name="classes", keep=True)
