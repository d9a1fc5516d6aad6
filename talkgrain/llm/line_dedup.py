"""Line dedup by a suffix array over line-ID sequences.

Every document is the sequence of its lines with a word in them. Lines that
occur once can be in no repeated run, so the sequences are cut at them; what
stays is a set of segments of repeated lines, in which every line gets a
position: positions grow with the corpus order (by id, then by text hash, then
by line), and consecutive lines of a segment have consecutive ones.

The suffixes of the segments are sorted by distributed prefix doubling: a
suffix's rank is the place of its class, the suffixes that share their first
``2^k`` lines, and a class of ``n`` suffixes takes the ``n`` places from its rank
on. A round splits each class by the ranks of the suffixes that start ``2^k``
lines later; classes of one suffix, and suffixes that end with their segment,
are done.

Each class is an interval of the suffix array with a longest common prefix of
``2^k`` lines or more; all its suffixes but the earliest begin a copy of so many
lines. So a suffix's longest copy lies between the last round in which it was
not the earliest of its interval and the next. Intervals between the two rounds
come from refining: of an interval's parts in the next round only the earliest
suffixes matter, and bit by bit, the highest first, they are parted by the
class of the suffix that starts where their known common prefix ends. Suffixes
that stay together have a longer common prefix, and of all but their earliest
so has the longest copy; the earliest one stands for them in the wider
interval. So both passes take as many rounds as the longest run's length has
bits, whatever the data's size.

A group of any size (a class, or a part of one) is counted with partial sums
and told what it is by an equi-join, whose skewed partitions Spark splits; sums
along ranks are taken in two levels. So no task holds a group. Each step is a
small plan of its own, written to the shared folder.

A copy of at least ``min_words`` words is deleted; the earliest occurrence
stays. All of it is DataFrame operations.

Null and empty texts have no lines and stay as they are; rows with a null id
stay as they are and delete nothing from others. Rows that repeat an id with
the same text are one document and are edited alike; with different texts they
are documents of their own. An empty table gives an empty result; further
columns of ``docs`` stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm.common import WORD_PATTERN, bound, cut, discard, free_name, reread, temporary


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``d, v, line, j, h, g, words``: each line with a word, once a document, by document, place and place among those lines."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("v", F.xxhash64("_text")).select("d", "v", F.posexplode(_lines(F.col("_text"))).alias("line", "_line"))
    rows = rows.withColumn("words", F.regexp_count("_line", F.lit(WORD_PATTERN))).where("words > 0")
    rows = rows.select("d", "v", "line", F.xxhash64("_line").alias("h"), F.hash("_line").alias("g"), "words")
    rows = rows.withColumn("j", F.dense_rank().over(W.partitionBy("d", "v").orderBy("line")).cast("bigint"))
    return rows.withColumn("_again", F.row_number().over(W.partitionBy("d", "v", "line").orderBy("line"))).where("_again = 1").drop("_again")


def _segments(lines: DataFrame) -> DataFrame:
    """``pos, seg, d, v, line, words, left, rank, n``: repeated lines, where their segment begins and how many lines it still has, the rank and size of their class."""
    repeated = lines.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").withColumn("_b", F.shiftright("h", 52))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("_b").orderBy("h", "g").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = repeated.groupBy("_b").agg(F.sum("n").alias("_n"))
    buckets = buckets.select("_b", F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    ranked = repeated.withColumn("_inside", inside).join(buckets, "_b").select("h", "g", "n", (F.col("_start") + F.col("_inside")).alias("rank"))
    # Places among the lines with a word: consecutive ones may be repeated together whatever stands between.
    found = cut(lines.join(ranked, ["h", "g"]).select("d", "v", "j", "line", "words", "rank", "n"), name="repeated").repartitionByRange("d", "v")
    found = found.withColumn("_run", F.col("j") - F.row_number().over(W.partitionBy("d", "v").orderBy("j")))
    run = W.partitionBy("d", "v", "_run")
    found = found.withColumn("left", F.max("j").over(run) - F.col("j") + 1).withColumn("_in", F.col("j") - F.min("j").over(run))
    found = found.sortWithinPartitions("d", "v", "j").withColumn("pos", F.monotonically_increasing_id())
    return found.select("pos", (F.col("pos") - F.col("_in")).alias("seg"), "d", "v", "line", "words", "left", "rank", "n")


def _classes(pairs: DataFrame) -> DataFrame:
    """``rank, later, to, size, head``: the interval of each pair of a rank and a later rank, its first place, size and earliest suffix."""
    pairs = pairs.groupBy("rank", "later").agg(F.count("*").alias("size"), F.min("pos").alias("head")).withColumn("_b", F.shiftright("later", 14))
    inside = F.coalesce(F.sum("size").over(W.partitionBy("rank", "_b").orderBy("later").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = pairs.groupBy("rank", "_b").agg(F.sum("size").alias("_all"))
    start = F.coalesce(F.sum("_all").over(W.partitionBy("rank").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = buckets.select("rank", "_b", start.alias("_start"))
    pairs = pairs.withColumn("_inside", inside).join(buckets, ["rank", "_b"])
    return pairs.select("rank", "later", (F.col("rank") + F.col("_start") + F.col("_inside")).alias("to"), "size", "head")


#: Suffixes that share a class, and whose segments go on: the next round is theirs.
_GOES_ON = "size > 1 AND later >= 0"


def suffix_array(segments: DataFrame) -> list[DataFrame]:
    """A table a round ``k``: ``pos, left, rank, n, own`` of the suffixes whose class shares ``2^k`` lines, and ``later, to, size, head`` of the class's part they are in.

    ``own``: not the earliest of the class. The last ranks, ``to``, of all rounds
    together are the suffix array's.
    """
    heads = segments.groupBy("rank").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    # Before the first round: each suffix in the class of its first line. Only whether it is the earliest one is known of that.
    head = F.when(F.col("_first"), F.col("pos")).otherwise(-1)
    start = segments.join(heads, "pos", "left").select(F.lit(-1).alias("round"), "seg", "pos", "left", "rank", "n", F.lit(False).alias("own"), F.lit(0).cast("bigint").alias("later"), F.col("rank").alias("to"), F.col("n").alias("size"), head.alias("head"))
    rounds = [cut(start, name="ranks")]
    while not rounds[-1].where(_GOES_ON).isEmpty():
        k = len(rounds) - 1
        step = 1 << k
        # Of every suffix its last round's rank: one scan of all rounds.
        newest = F.col("round") == k - 1
        known = reread(rounds).where(newest | ~F.expr(_GOES_ON)).withColumn("_later", F.lead("to", step).over(W.partitionBy("seg").orderBy("pos")))
        rows = known.where(newest).where(_GOES_ON).select("seg", "pos", "left", F.col("to").alias("rank"), F.col("size").alias("n"), (F.col("pos") != F.col("head")).alias("own"), F.when(F.col("left") > step, F.col("_later")).otherwise(-1).alias("later"))
        rows = cut(rows, name="pairs")
        classes = cut(_classes(rows), name="classes")
        found = rows.join(classes, ["rank", "later"])
        rounds.append(cut(found.select(F.lit(k).alias("round"), "seg", "pos", "left", "rank", "n", "own", "later", "to", "size", "head"), name="ranks"))
        discard(rows)
        discard(classes)
    return rounds[1:]


def longest_copies(segments: DataFrame) -> DataFrame:
    """``pos, copy``: of each suffix, how many lines it begins with occur earlier (left out: none)."""
    rounds = suffix_array(segments)
    if not rounds:
        return segments.select("pos", F.lit(0).alias("copy")).limit(0)
    lists = None
    for b in reversed(range(len(rounds) - 1)):
        # The earliest suffixes of the parts of each interval of the round above, which share 2^(b + 1) lines and not twice as many.
        parts = rounds[b + 1].where("pos = head AND size < n").select("pos", "left", F.lit(2 << b).alias("shared"), F.col("rank").alias("list"), "own")
        lists = cut(_refined(parts if lists is None else lists.unionByName(parts), rounds[b].select(F.col("pos").alias("_at"), F.col("rank").alias("then")), 1 << b), name="intervals")
    # Equal to their segments' ends: all but the earliest are copies as a whole. With the first line only in common: copies of that line.
    whole, single = F.expr("later < 0 AND pos <> head"), F.expr("round = 0 AND own AND pos = head")
    found = reread(rounds).where(whole | single).select("pos", F.when(whole, F.col("left")).otherwise(1).cast("int").alias("copy"))
    return found if lists is None else found.unionByName(lists.where("own").select("pos", F.col("shared").alias("copy")))


def _refined(lists: DataFrame, ranks: DataFrame, step: int) -> DataFrame:
    """The lists parted by whether suffixes share ``step`` lines more: ``pos, left, shared, list, own``.

    ``shared`` lines and ``list`` name an interval; suffixes that share more go
    to the narrower one, named by its earliest suffix, which stays for them in
    the wider one. There it may still have a copy of its own; in the narrower
    one it is but a witness.
    """
    key = ["shared", "list", "then"]
    # Where nothing is looked up the key is a place that no line has, not a null that many rows share.
    rows = lists.withColumn("_at", F.when(F.col("shared") + step <= F.col("left"), F.col("pos") + F.col("shared")).otherwise(-1 - F.col("pos")))
    rows = rows.join(ranks, "_at", "left").withColumn("then", F.coalesce("then", -1 - F.col("pos"))).drop("_at")
    whole = rows.groupBy(*key).agg(F.count("*").alias("size"), F.min("pos").alias("head")).where("size > 1")
    rows = rows.join(whole, key, "left")
    is_head = F.col("pos") == F.col("head")
    stays = F.struct("pos", "left", "shared", "list", "own")
    goes = F.struct("pos", "left", (F.col("shared") + step).alias("shared"), F.col("head").alias("list"), (F.col("own") & ~is_head).alias("own"))
    both = F.when(F.col("head").isNull(), F.array(stays)).when(is_head, F.array(stays, goes)).otherwise(F.array(goes))
    return rows.select(F.inline(both))


def deletions(docs: DataFrame, *, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d, v, lines, n_words``: for each document with deleted lines (id, xxhash64 of the text) their numbers from 0, and their words."""
    with temporary():
        return cut(_deletions(docs, min_words, id_col, text_col), name="deletions", keep=True)


def _deletions(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    lines = cut(line_table(docs, id_col, text_col), name="lines")
    segments = cut(_segments(lines), name="segments")
    discard(lines)
    copies = longest_copies(segments.select("pos", "seg", "left", "rank", "n"))
    document = W.partitionBy("d", "v").orderBy("pos")
    rows = segments.select("pos", "d", "v", "line", "words").withColumn("_sum", F.sum("words").over(document))
    ends = rows.select((F.col("pos") + 1).alias("_end"), F.col("_sum").alias("_upto"))
    rows = rows.join(copies, "pos", "left").withColumn("_end", F.coalesce(F.col("pos") + F.col("copy"), -1 - F.col("pos"))).join(ends, "_end", "left")
    # Where nothing is looked up the key is a place that no line has, not a null that many rows share.
    long = F.col("_upto") - F.col("_sum") + F.col("words") >= min_words
    reach = F.max(F.when(long, F.col("_end"))).over(document)
    rows = rows.withColumn("_reach", reach).where(F.col("_reach") > F.col("pos"))
    return rows.groupBy("d", "v").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.sum("words").alias("n_words"))


def dedup_lines(docs: DataFrame, *, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later copies of repeated line runs deleted from the texts; all columns and rows stay."""
    names = docs.columns
    d, v, gone, h = (free_name(names, c) for c in ("_d", "_v", "_gone", "_hash"))
    found = deletions(docs, min_words=min_words, id_col=id_col, text_col=text_col).select(F.col("d").alias(d), F.col("v").alias(v), F.col("lines").alias(gone))
    joined = docs.withColumn(h, F.xxhash64(F.col(text_col).cast("string"))).join(found, (F.col(id_col) == F.col(d)) & (F.col(h) == F.col(v)), "left")

    def without(lines: Column) -> Column:
        """The lines between one deleted line and the next, joined; each line is touched once."""
        before = lambda k: F.coalesce(F.get(gone, k - 1), F.lit(-1))
        after = lambda k: F.coalesce(F.get(gone, k), F.size(lines))
        between = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(lines, before(k) + 2, after(k) - before(k) - 1))
        return F.array_join(F.flatten(between), "\n")

    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(bound(_lines(F.col(text_col).cast("string")), without))
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in names))
