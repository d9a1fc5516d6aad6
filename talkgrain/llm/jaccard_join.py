"""Grouped prefix join: documents whose sets of word shingles are near-equal.

Texts with the same set are one node. In an order of all shingles, rare ones
first, two sets that share enough of their shingles share one among the first
few of each (their prefixes). Nodes with the same prefix and size are one group;
an index from the shingles of prefixes to groups gives pairs of groups, filtered
by size and by how much the positions leave to share; pairs are expanded to
members and verified on whole sets.

The order comes from a sketch of a fixed size that counts the shingles of all
documents by their hash; any order that all documents agree on is right, and
this one keeps passages that many documents share out of the prefixes.

Only who is connected is asked for, so pairs inside a large group need not all
be made. Lists are dealt into chunks of a bounded number of entries. First each
entry is tried with the entry before it and with the first one of its chunk,
and that one with the list's first, which joins up a group of near copies with
a pair or two for each member. Then the remaining pairs, between members that
are not connected yet, are made, filtered and verified. Members of a list of
more than a few bring a fixed number of bits, the parities of how many of their
shingles have each value of the last bits of the hash: two sets differ in at
least as many shingles as they do in bits, so most texts that just miss a link
are told apart where they meet. Such pairs are made in the first list of more
than a few that both share. Lists are paired chunk by chunk, so no task holds a
whole list; nothing is capped.

Null and empty texts, and texts of white space, have empty sets: they link with
nothing and their component is their own id. A null id takes no part and has a
null component. Rows that repeat an id are one document with all their links;
each row has its own set's size. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm.common import cut, discard, ensure_importable, free_name, map_arrow, mixed, temporary, texts_of, window_hashes, word_hashes
from talkgrain.llm.components import components

_CHUNK = 1 << 14


@dataclass(frozen=True)
class Similarity:
    """Linked at ``intersection / union >= numerator / denominator``; ``width`` words a shingle."""

    width: int = 3
    numerator: int = 9
    denominator: int = 10
    sketch_bits: int = 20
    filter_bits: int = 23
    list_rows: int = 1024
    few_rows: int = 16

    def prefix(self, size: int) -> int:
        """How many shingles of a set cover what a partner may lack, and one more, so that a linked set shares one of them."""
        return size + (-size * self.numerator // self.denominator) + 1

    def beyond_prefix(self, n):
        """How many shingles of a set (a column of sizes) come after its prefix."""
        return F.ceil(n * self.numerator / self.denominator) - 1

    @property
    def total(self) -> int:
        """``total * shared >= numerator * (size + size)`` says that two sets are linked."""
        return self.numerator + self.denominator


def shingles(text: bytes, width: int) -> np.ndarray:
    """The sorted set of hashes of a text's shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


#: Numbers of 64 bits that hold the parities of a set.
_PARITIES = 4


def parities(own: np.ndarray) -> np.ndarray:
    """Whether the number of hashes with each value of their last eight bits is odd, a bit each."""
    return np.packbits(np.bincount((own & np.uint64(64 * _PARITIES - 1)).astype(np.int64), minlength=64 * _PARITIES) & 1).view(np.int64)


def frequency_sketch(docs: DataFrame, text_col: str, sim: Similarity) -> np.ndarray:
    """How many shingles of all documents fall on each value of the first bits of a hash, as numbers of 21 bits that grow with it."""
    ensure_importable(docs.sparkSession)
    size, shift = 1 << sim.sketch_bits, np.uint64(64 - sim.sketch_bits)
    chunk = min(_CHUNK, size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size, np.uint64)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                sets = [shingles(t, sim.width) for t in texts_of(batch.column(0).slice(start, 500))]
                total += np.bincount(np.concatenate(sets) >> shift, minlength=size).astype(np.uint64)
        salt = TaskContext.get().partitionId() % 64
        rows = [(k, total[k : k + chunk]) for k in range(0, size, chunk)]
        rows = [(k, part.tobytes()) for k, part in rows if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([salt] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "salt", "counts"])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chunk, np.uint64)
        first = None
        for batch in rows:
            first = first or (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            for raw in batch.column(2).to_pylist():
                total += np.frombuffer(raw, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()), pa.array([total.tobytes()])], ["chunk", "salt", "counts"])

    schema = "chunk bigint, salt bigint, counts binary"
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(count, schema)
    for keys in (["chunk", "salt"], ["chunk"]):
        parts = parts.groupBy(*keys).applyInArrow(add, schema)
    sketch = np.zeros(size, np.uint64)
    for row in parts.select("chunk", "counts").collect():
        sketch[row.chunk : row.chunk + chunk] = np.frombuffer(row.counts, np.uint64)
    # By magnitude, to a part in two thousand: 21 bits for any count.
    return sketch.astype(np.float32).view(np.uint32) >> np.uint32(11)


def signatures(docs: DataFrame, id_col: str, text_col: str, sim: Similarity) -> DataFrame:
    """``_id, n, key, group, prefix, bits``: key names the set, group its prefix and size; they are null for empty sets."""
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, text_col, sim))
    shift = np.uint64(64 - sim.sketch_bits)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = sketch.value
        sizes, keys, groups, prefixes, bits = [], [], [], [], []
        for text in texts_of(batch.column(1)):
            own = shingles(text, sim.width)
            sizes.append(len(own))
            if not len(own):
                keys.append(None)
                groups.append(None)
                prefixes.append(None)
                bits.append(np.zeros(_PARITIES, np.int64))
                continue
            rank = (counts[own >> shift].astype(np.uint64) << np.uint64(43)) | (mixed(own) >> np.uint64(21))
            prefix = own[np.argsort(rank, kind="stable")[: sim.prefix(len(own))]]
            keys.append(xxhash.xxh3_128_digest(own.tobytes()))
            groups.append(xxhash.xxh3_128_digest(prefix.tobytes() + len(own).to_bytes(8, "little")))
            prefixes.append(prefix.view(np.int64))
            bits.append(parities(own))
        words = pa.StructArray.from_arrays([pa.array([b[k] for b in bits], pa.int64()) for k in range(_PARITIES)], [f"w{k}" for k in range(_PARITIES)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(groups, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), words], ["_id", "n", "key", "group", "prefix", "bits"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    words = ", ".join(f"w{k}: bigint" for k in range(_PARITIES))
    return cut(map_arrow(rows, run, f"_id {kind}, n bigint, key binary, group binary, prefix array<bigint>, bits struct<{words}>"), name="signatures")


def _verified(docs: DataFrame, id_col: str, text_col: str, pairs: DataFrame, nodes: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, by their whole sets, which come from the texts again.

    A filter of a fixed size, over the hashes of the pairs' ids, keeps most
    other texts from being worked on; the joins by id and set make it exact.
    """
    bits = 1 << sim.filter_bits
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    ends = pairs.select(place(F.col("a")).alias("h")).unionByName(pairs.select(place(F.col("b")).alias("h")))
    words = ends.groupBy(F.expr("h div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("m"))
    mask = np.zeros(bits // 64, np.int64)
    for row in words.collect():
        mask[row.w] = row.m
    passes = docs.sparkSession.sparkContext.broadcast(mask.view(np.uint64))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h = batch.column(2).to_numpy().astype(np.uint64)
        here = (passes.value[h >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) > 0
        return pa.RecordBatch.from_arrays(batch.columns[:2], ["rep", "text"]).filter(pa.array(here))

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), place(F.col(id_col)).alias("_h"))
    texts = cut(map_arrow(rows, run, f"rep {kind}, text string"), name="texts")
    keyed = pairs.join(nodes.select(F.col("rep").alias("a"), F.col("key").alias("_ka")), "a").join(nodes.select(F.col("rep").alias("b"), F.col("key").alias("_kb")), "b")
    # Texts are a third of the size of their sets: they travel, and sets are made where two of them meet.
    both = keyed.join(texts.toDF("a", "_left"), "a").join(texts.toDF("b", "_right"), "b").select("a", "b", "_ka", "_kb", "_left", "_right")

    def linked(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for ka, kb, left, right in zip(*(batch.column(k).to_pylist() for k in (2, 3)), *(texts_of(batch.column(k)) for k in (4, 5)), strict=True):
            x, y = shingles(left, sim.width), shingles(right, sim.width)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            own = xxhash.xxh3_128_digest(x.tobytes()) == ka and xxhash.xxh3_128_digest(y.tobytes()) == kb
            good.append(own and sim.total * shared >= sim.numerator * (len(x) + len(y)))
        return pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    found = cut(map_arrow(both, linked, f"a {kind}, b {kind}").distinct(), name="linked")
    discard(texts)
    return found


def _promising(pairs: DataFrame, index: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs of groups ``(ga, gb)`` whose prefixes share enough.

    Of two sets, the one whose prefix ends first in the order shares with the
    other what the prefixes share, and of its rest no more than it has.
    """
    wanted = pairs.select(F.col("ga").alias("gid")).union(pairs.select("gb")).distinct()
    lists = cut(index.join(wanted, "gid", "left_semi").groupBy("gid").agg(F.collect_list("s").alias("_s"), F.min("n").alias("_n")), name="prefixes")
    both = pairs.join(lists.toDF("ga", "_sa", "_na"), "ga").join(lists.toDF("gb", "_sb", "_nb"), "gb")
    most = F.size(F.array_intersect("_sa", "_sb")) + F.greatest(sim.beyond_prefix(F.col("_na")), sim.beyond_prefix(F.col("_nb")))
    return both.where(sim.total * most >= sim.numerator * (F.col("_na") + F.col("_nb"))).select("ga", "gb")


def _across(rows: DataFrame, keys: list[str], sim: Similarity) -> DataFrame:
    """Pairs of ``rows`` with the same keys and different components, the second one's columns behind ``o_``.

    Only keys with several components take part. Their rows are dealt into
    chunks, and each pair of chunks is a key of the join of its own. Pairs with
    more different bits than sets that are linked may have are not made.
    """
    lists = rows.groupBy(*keys).agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_rows")).where("_low <> _high")
    chunks = F.ceil(F.col("_rows") / sim.list_rows).cast("int")
    dealt = rows.join(lists.select(*keys, chunks.alias("_chunks")), keys).withColumn("_chunk", F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int"))
    dealt = cut(dealt, name="rest")
    every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    names = [c for c in rows.columns if c not in keys]
    left = dealt.select(*keys, *names, F.col("_chunk").alias("_i"), every.alias("_j"))
    right = dealt.select(*keys, *(F.col(c).alias(f"o_{c}") for c in names), every.alias("_i"), F.col("_chunk").alias("_j"))
    # Few bytes make many comparisons here, and partitions that are numbered are not put together by their bytes.
    parts, meet = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*keys, "_i", "_j"]
    size = F.col("n") + F.col("o_n")
    differ = sum((F.bit_count(F.col(f"bits.w{k}").bitwiseXOR(F.col(f"o_bits.w{k}"))) for k in range(_PARITIES)), F.lit(0))
    alike = F.coalesce(sim.total * (size - differ) >= 2 * sim.numerator * size, F.lit(True))
    return left.repartition(parts, *meet).join(right.repartition(parts, *meet), meet).where((F.col("rep") < F.col("o_rep")) & (F.col("component") != F.col("o_component")) & alike)


def near_duplicates(docs: DataFrame, sim: Similarity | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row."""
    with temporary():
        return cut(_near_duplicates(docs, sim or Similarity(), id_col, text_col), name="classes", keep=True)


def _near_duplicates(docs: DataFrame, sim: Similarity, id_col: str, text_col: str) -> DataFrame:
    signed = signatures(docs, id_col, text_col, sim)
    full = signed.where("_id IS NOT NULL AND n > 0")
    nodes = cut(full.groupBy("key").agg(F.min("_id").alias("rep"), F.min("n").alias("n"), F.min("group").alias("group"), F.min("bits").alias("bits")), name="nodes")
    # A group's number is given once, in what is written: whatever ids are, entries and pairs of groups stay short.
    groups = full.groupBy("group").agg(F.min("_id").alias("lead"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    prefixes = cut(groups.select(F.monotonically_increasing_id().alias("gid"), "group", "lead", "n", "prefix"), name="prefixes")
    members = cut(nodes.join(prefixes.select("group", "gid", "lead"), "group").select("rep", "key", "gid", "lead"), name="members")
    # Prefixes are most of what is written, and need not be there twice.
    sets = cut(signed.select("_id", "n", "key"), name="sets")
    discard(signed)
    full = sets.where("_id IS NOT NULL AND n > 0")

    # The index: what prefixes hold, with the neighbours of each entry in its chunk of its shingle's list.
    entries = prefixes.select("gid", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "s"))
    # An entry alone in its list has no other to be tried with. Most are, so shingles are counted by themselves and only the other entries go on.
    lists = cut(entries.groupBy("s").agg(F.count("*").alias("_entries")).where("_entries > 1"), name="lists")
    entries = cut(entries.join(lists, "s"), name="entries")
    # An entry whose shared shingles come early has few of its own: the first one links with most of its list.
    entry, place = F.struct("gid", "n", "pos"), F.struct("pos", "n", "gid")
    heads = entries.groupBy("s").agg(F.min_by(entry, place).alias("_head"))
    chunk = F.pmod(F.xxhash64("gid"), F.ceil(F.col("_entries") / sim.list_rows)).cast("int")
    listed = W.partitionBy("s", "_chunk").orderBy("pos", "n", "gid")
    index = entries.join(heads, "s").withColumn("_chunk", chunk).repartition("s", "_chunk")
    index = index.withColumn("_before", F.lag(entry).over(listed)).withColumn("_first", F.coalesce(F.when(F.col("_before").isNull(), F.col("_head")), F.first(entry).over(listed)))
    index = cut(index.select("s", "gid", "n", "pos", "_before", "_first"), name="index")
    discard(entries)
    leads = cut(prefixes.select("gid", "lead"), name="leads")
    discard(prefixes)

    def fits(n1, p1, n2, p2):
        """Whether sizes and positions leave enough to share."""
        return sim.total * F.least(n1 - p1, n2 - p2) >= sim.numerator * (n1 + n2)

    near = index.select("gid", "n", "pos", F.explode(F.array("_before", "_first")).alias("o")).where("o IS NOT NULL").where(fits(F.col("n"), F.col("pos"), F.col("o.n"), F.col("o.pos")))
    near = near.select(F.least("gid", "o.gid").alias("ga"), F.greatest("gid", "o.gid").alias("gb"))
    inside = members.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    near = cut(near.where("ga <> gb").distinct(), name="near")
    good = _promising(near, index, sim).join(leads.toDF("ga", "_la"), "ga").join(leads.toDF("gb", "_lb"), "gb")
    good = good.where("_la <> _lb").select(F.least("_la", "_lb").alias("a"), F.greatest("_la", "_lb").alias("b"))
    tried = cut(good.unionByName(inside).distinct(), name="pairs")
    linked = _verified(docs, id_col, text_col, tried, nodes, sim)
    several = full.groupBy("_id").agg(F.min("key").alias("_one"), F.max("key").alias("_other")).where("_one <> _other").select("_id")
    same_id = full.join(several, "_id", "left_semi").join(nodes.select("key", "rep"), "key").select(F.col("_id").alias("a"), F.col("rep").alias("b"))
    first = components(linked.unionByName(same_id))

    # The rest: pairs of members that are not connected yet, from lists and groups that hold several components.
    placed = members.join(first.withColumnRenamed("node", "rep"), "rep", "left").select("gid", "rep", F.coalesce("component", "rep").alias("component"))
    held = index.select("s", "gid", "n", "pos").join(placed, "gid")
    mixed_lists = held.groupBy("s").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_rows")).where("_low <> _high")
    mixed_lists = cut(mixed_lists.select("s", F.monotonically_increasing_id().alias("_list"), (F.col("_rows") > sim.few_rows).alias("_many")), name="mixed_lists")
    rest = cut(held.join(mixed_lists, "s"), name="mixed")
    # In lists of a few, where most entries are, pairs are no more than some for each entry: nothing else travels.
    bits = nodes.select("rep", "bits")
    few = rest.where("NOT _many").select("s", "gid", "n", "pos", "rep", "component", F.lit(None).cast(bits.schema["bits"].dataType).alias("bits"), F.array().cast("array<bigint>").alias("_earlier"))
    # In the others an entry takes with it, by short numbers, which of them its group stands in earlier, and what its set's bits are.
    many = rest.where("_many")
    own = many.select("gid", "pos", "_list").distinct().groupBy("gid").agg(F.collect_list(F.struct("pos", "_list")).alias("_own"))
    earlier = F.transform(F.filter("_own", lambda e: e["pos"] < F.col("pos")), lambda e: e["_list"])
    many = many.join(own, "gid").join(bits, "rep").select("s", "gid", "n", "pos", "rep", "component", "bits", earlier.alias("_earlier"))
    # What two members share first is in a list of a few, or in the first of the others that both are in.
    first_shared = fits(F.col("n"), F.col("pos"), F.col("o_n"), F.col("o_pos")) & ~F.arrays_overlap("_earlier", "o__earlier")
    pairs = _across(few.unionByName(many), ["s"], sim).where((F.col("gid") != F.col("o_gid")) & first_shared)
    pairs = cut(pairs.select(F.col("rep").alias("a"), F.col("o_rep").alias("b"), F.col("gid").alias("ga"), F.col("o_gid").alias("gb")).distinct(), name="rest_pairs")
    among = F.least("ga", "gb").alias("ga"), F.greatest("ga", "gb").alias("gb")
    good = _promising(pairs.select(*among).distinct(), index, sim)
    pairs = pairs.select("a", "b", *among).join(good, ["ga", "gb"]).select("a", "b")
    # Members of one group share a whole prefix, which the index need not hold.
    within = _across(placed.join(nodes.select("rep", "n", "bits"), "rep"), ["gid"], sim)
    met = cut(pairs.unionByName(within.select(F.col("rep").alias("a"), F.col("o_rep").alias("b"))), name="met")
    pairs = cut(met.join(tried, ["a", "b"], "left_anti"), name="pairs")
    if not pairs.isEmpty():
        crossing = _verified(docs, id_col, text_col, pairs, nodes, sim)
        places = placed.select("rep", "component")
        bridges = crossing.join(places.toDF("a", "_ca"), "a").join(places.toDF("b", "_cb"), "b").select(F.col("_ca").alias("a"), F.col("_cb").alias("b"))
        second = components(bridges).withColumnRenamed("component", "_joined")
        placed = placed.join(second.withColumnRenamed("node", "component"), "component", "left").select("gid", "rep", F.coalesce("_joined", "component").alias("component"))

    classes = nodes.select("key", "rep").join(placed.select("rep", F.col("component").alias("_component")).distinct(), "rep").select("key", "_component")
    answer = sets.select("_id", "n", F.when(F.col("_id").isNotNull(), F.col("key")).alias("key")).join(classes, "key", "left")
    return answer.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_component", "_id").alias("component_id"))


def keep_one(docs: DataFrame, sim: Similarity | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the least id; rows without an id stay.

    Texts that share an id are documents of their own, of which the one with the
    least hash comes first, so no text is lost that has no near copy. Of rows
    that repeat id and text, the one with the least hash of all columns stays.
    """
    name = free_name(docs.columns, "_key")
    keyed = docs.where(F.col(id_col).isNotNull()).withColumn(name, F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text")))
    found = near_duplicates(keyed, sim, id_col=name, text_col=text_col)
    kept = found.where(F.col(name) == F.col("component_id")).groupBy(name).agg(F.count("*").alias("_rows"))
    # A null text has a hash too; rows that repeat a key are few and meet by it.
    once = keyed.join(kept.where("_rows = 1").select(name), name, "left_semi").select(docs.columns)
    told = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    several = keyed.join(kept.where("_rows > 1").select(name), name, "left_semi").groupBy(name).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*told)).alias("_row"))
    return once.unionByName(several.select("_row.*")).unionByName(docs.where(F.col(id_col).isNull()))


#: For three words a shingle and 0.9; ids must be unique.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT d.doc_id, COALESCE(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(c) AS c FROM r GROUP BY a) c ON c.a = d.doc_id
"""
