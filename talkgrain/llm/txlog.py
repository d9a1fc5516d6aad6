"""Transaction logs put together again: which changes stay, which are undone and by what, and the store they build.

A log has rows ``seq bigint, stream string, op string, key, value``; ``op`` is ``commit``,
``abort``, ``savepoint``, ``rollback`` or ``change``. By ascending ``seq`` each stream (null is
one) runs one transaction after the other. A rollback undoes what is left of its
transaction's changes since the latest savepoint (none: since its start) and
removes that savepoint; a commit applies what is left, in order, to one store;
an abort, or the end of the log, undoes it.

The log is cut into chunks of 1,024 numbers. What a chunk does to a stream is
three numbers: how often it ends a transaction, how many rollbacks find no
savepoint of their own in it, and how many savepoints it leaves open. These
summaries are associative; a scan over chunks tells each chunk in which
transaction, and how many savepoints deep, it begins, and with this its rows are resolved
where they are. A change made under ``d`` open savepoints is undone by the next
rollback of its transaction that is made under ``d`` too: depth moves by one, so
none can pass below without one at it. Within a chunk this is a window; the
changes still pending at its end learn from a second scan, backwards over
chunks, by which rollback they go, if any.

No window is longer than a chunk or a block of a scan, so a stream, a
transaction or a key with any share of the log is spread over many tasks.

Rows with a null ``seq`` have no place in the log and are left out. Rows with one
``seq`` follow each other by stream, then op, key and value (null first). A
change without a value deletes its key; a null key is a key. Other ops are no records. An
empty log gives no rows, and a log without commits no epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.llm import scan as S
from talkgrain.llm.common import CRC32_TABLE, crc32_sql, cut, temporary

#: A chunk is so many bits of ``seq``.
CHUNK_BITS = 10

OPS = ("commit", "abort", "savepoint", "rollback", "change")


def effect(op: Column) -> Column:
    """What one record does to its stream."""
    one = lambda *ops: op.isin(*ops).cast("bigint")
    return F.struct(one("commit", "abort").alias("ends"), one("rollback").alias("down"), one("savepoint").alias("up"))


def _joined(a: Column, b: Column) -> Column:
    """First ``a``, then ``b``: a depth goes down, at most to 0, and then up; behind an end only ``up`` counts."""
    up = F.when(b["ends"] > 0, b["up"]).otherwise(F.greatest(a["up"] - b["down"], F.lit(0)) + b["up"])
    down = F.when((a["ends"] > 0) | (b["ends"] > 0), F.lit(0)).otherwise(a["down"] + F.greatest(b["down"] - a["up"], F.lit(0)))
    return F.struct((a["ends"] + b["ends"]).cast("bigint").alias("ends"), down.cast("bigint").alias("down"), up.cast("bigint").alias("up"))


def _running(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The clamped walk as running sums: it stands above its unclamped twin by as much as that one has been below 0."""
    v, w = F.col("value"), W.partitionBy(*keys).orderBy("place")
    run = [*keys, "_ends"]
    before = W.partitionBy(*run).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_ends", F.coalesce(F.sum(v["ends"]).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_left", F.coalesce(F.lag(v["up"]).over(w), F.lit(0)))
    # A run of rows begins behind an end, with the savepoints that the row of the end leaves.
    rows = rows.withColumn("_start", F.when(F.col("_ends") > 0, F.first("_left").over(W.partitionBy(*run).orderBy("place").rowsBetween(W.unboundedPreceding, 0))).otherwise(F.lit(0)))
    rows = rows.withColumn("_walk", F.col("_start") + F.coalesce(F.sum(v["up"] - v["down"]).over(before), F.lit(0)))
    below = F.greatest(-F.coalesce(F.min(F.col("_walk") - v["down"]).over(before), F.lit(0)), F.lit(0))
    rows = rows.withColumn("_below", below)
    state = F.struct(F.col("_ends").cast("bigint").alias("ends"), F.when(F.col("_ends") > 0, F.lit(0)).otherwise(F.col("_below")).cast("bigint").alias("down"), (F.col("_walk") + F.col("_below")).cast("bigint").alias("up"))
    return rows.withColumn("before", state).drop("_ends", "_left", "_start", "_walk", "_below")


DEPTHS = S.Summary(_running, _joined)


def _span(rows: DataFrame, place: str) -> int:
    low, high = rows.agg(F.min(place), F.max(place)).first()
    return 1 if low is None else high - low + 1


def resolve(log: DataFrame, *, chunk_bits: int = CHUNK_BITS, scan_bits: int = S.BITS) -> tuple[DataFrame, DataFrame]:
    """``changes`` and ``commits``.

    Changes have the columns of the log but for ``op``, and ``fate`` (``commit``, ``abort`` or ``rollback``), ``by`` (the
    ``seq`` of the record that decided; null for the log's end), ``number`` (of the
    commit) and ``rank`` (their order under one number). Commits have ``seq`` and ``number``, from 1 on.
    """
    with temporary():
        # A null stream is one of its own, before all others.
        stream = F.coalesce(F.concat(F.lit("s"), F.col("stream").cast("string")), F.lit(""))
        known = log.where(F.col("seq").isNotNull() & F.col("op").isin(*OPS))
        rows = known.select(F.col("seq").cast("bigint").alias("seq"), stream.alias("_s"), "stream", "op", "key", F.col("value").alias("what"), F.shiftright(F.col("seq").cast("bigint"), chunk_bits).alias("chunk"))
        rows = rows.withColumn("place", F.row_number().over(W.partitionBy("chunk", "_s").orderBy("seq", "op", "key", "what")).cast("bigint")).withColumn("value", effect(F.col("op")))
        local = cut(_running(rows, ["chunk", "_s"]).withColumnRenamed("before", "_inner"), name="local")
        span = _span(local, "chunk")

        chunks = local.groupBy("_s", F.col("chunk").alias("place")).agg(F.max_by(_joined(F.col("_inner"), F.col("value")), F.col("place")).alias("value"))
        begins = S.scan(chunks, ["_s"], span, DEPTHS, scan_bits).select("_s", F.col("place").alias("chunk"), F.col("before").alias("_outer"))
        state = _joined(F.col("_outer"), F.col("_inner"))
        placed = local.join(begins, ["_s", "chunk"]).withColumn("_state", state)
        placed = cut(placed.select("chunk", "_s", "place", "seq", "stream", "op", "key", "what", F.col("_state.ends").alias("txn"), F.col("_state.up").alias("depth")), name="placed")

        commits = placed.where("op = 'commit'").withColumn("_k", F.row_number().over(W.partitionBy("chunk").orderBy("seq", "_s", "place")))
        per_chunk = commits.groupBy(F.lit(0).alias("log"), F.col("chunk").alias("place")).agg(F.struct(F.count("*").alias("n")).alias("value"))
        earlier = S.scan(per_chunk, ["log"], span, S.sums("n"), scan_bits).select(F.col("place").alias("chunk"), F.col("before.n").alias("_n"))
        commits = cut(commits.join(earlier, "chunk").select("_s", "txn", "seq", (F.col("_n") + F.col("_k")).alias("number")), name="commits", keep=True)
        aborts = placed.where("op = 'abort'").select("_s", "txn", F.lit("abort").alias("_end"), F.col("seq").alias("_end_seq"), F.lit(None).cast("bigint").alias("number"))
        ends = commits.select("_s", "txn", F.lit("commit").alias("_end"), F.col("seq").alias("_end_seq"), "number").unionByName(aborts)

        level = ["_s", "txn", "depth"]
        near = placed.where("op IN ('change', 'rollback')")
        backwards = W.partitionBy("chunk", *level).orderBy(F.col("place").desc()).rowsBetween(W.unboundedPreceding, -1)
        undoing = F.when(F.col("op") == "rollback", F.col("seq"))
        inside = near.withColumn("_here", F.last(undoing, ignorenulls=True).over(backwards))
        levels = near.groupBy(*level, (-F.col("chunk")).alias("place")).agg(F.min_by(undoing, F.when(F.col("op") == "rollback", F.col("place"))).alias("value"))
        later = S.scan(levels, level, span, S.latest(), scan_bits).where("before IS NOT NULL").select(*level, (-F.col("place")).alias("chunk"), F.col("before").alias("_later"))
        found = inside.where("op = 'change'").join(later, [*level, "chunk"], "left").join(ends, ["_s", "txn"], "left")
        by = F.coalesce("_here", "_later")
        fate = F.when(by.isNotNull(), "rollback").otherwise(F.coalesce("_end", F.lit("abort")))
        changes = found.select(
            "seq", "stream", "key", F.col("what").alias("value"), fate.alias("fate"), F.coalesce(by, "_end_seq").alias("by"),
            F.when(fate == "commit", F.col("number")).alias("number"), F.struct("chunk", "place").alias("rank"),
        )
        return cut(changes, name="changes", keep=True), commits.select("seq", "number")


def epoch_states(changes: DataFrame, commits: DataFrame, *, per_epoch: int = 64, scan_bits: int = S.BITS) -> DataFrame:
    """``epoch, n, total``: after every ``per_epoch`` commits, how many keys the store has and the sum of their values (numbers).

    The last write of each key in an epoch, less what the key had before, is what the epoch adds.
    """
    with temporary():
        epoch = F.expr(f"(number - 1) div {per_epoch} + 1")
        write = F.struct(F.col("value").isNotNull().cast("bigint").alias("n"), F.coalesce(F.col("value").cast("bigint"), F.lit(0)).alias("total"))
        # A null key is a key: it stands beside all others.
        last = changes.where("fate = 'commit'").groupBy(F.struct("key").alias("_key"), epoch.alias("place")).agg(F.max_by(write, F.struct("number", "rank")).alias("value"))
        epochs = cut(commits.groupBy(epoch.alias("place")).agg(F.count("*").alias("_commits")), name="epochs")
        span = _span(epochs, "place")
        writes = S.scan(last, ["_key"], span, S.latest(), scan_bits)
        more = [F.sum(F.col("value")[f] - F.coalesce(F.col("before")[f], F.lit(0))).alias(f"_{f}") for f in ("n", "total")]
        added = epochs.join(writes.groupBy("place").agg(*more), "place", "left")
        added = added.select(F.lit(0).alias("log"), "place", F.struct(*[F.coalesce(f"_{f}", F.lit(0)).cast("bigint").alias(f) for f in ("n", "total")]).alias("value"))
        states = S.scan(added, ["log"], span, S.sums("n", "total"), scan_bits)
        return cut(states.select(F.col("place").alias("epoch"), *[(F.col("before")[f] + F.col("value")[f]).alias(f) for f in ("n", "total")]), name="states", keep=True)


def final_store(changes: DataFrame) -> DataFrame:
    """``key, value, seq``: what the store holds at the end, and the change that each value comes from."""
    last = changes.where("fate = 'commit'").groupBy(F.struct("key").alias("_key")).agg(F.max_by(F.struct("value", "seq"), F.struct("number", "rank")).alias("_last"))
    return last.select("_key.key", "_last.value", "_last.seq").where("value IS NOT NULL")


def document_log(docs: DataFrame, labels: DataFrame, *, keys: int = 30_000) -> DataFrame:
    """Documents as log records: crc32 of the id says what each does; a value is the crc32 of ``key:text``.

    Only narrow rows leave the scan: texts are read once and become numbers there.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    toxic = labels.where("toxic = 1").select("doc_id").distinct().withColumn("_toxic", F.lit(True))
    kind, key = h % 17, F.floor(h / 100).cast("bigint") % keys
    op = F.when(kind <= 1, "commit").when(kind == 2, "abort").when(kind <= 4, "savepoint").when(kind <= 6, "rollback").otherwise("change")
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("source").alias("stream"), op.alias("op"), key.alias("_k"), F.crc32(F.concat(key.cast("string"), F.lit(":"), F.col("text").cast("string")).cast("binary")).alias("_v"))
    change = F.col("op") == "change"
    rows = rows.join(toxic, "doc_id", "left")
    return rows.select(F.col("doc_id").alias("seq"), "stream", "op", F.when(change, F.col("_k")).alias("key"), F.when(change & F.col("_toxic").isNull(), F.col("_v")).alias("value"))


def digest(changes: DataFrame, states: DataFrame) -> DataFrame:
    """``kind, id, n, value``: a row for each epoch, and for each change that was undone."""
    undone = changes.where("fate <> 'commit'").select(F.col("fate").alias("kind"), F.col("seq").alias("id"), F.col("by").alias("n"), F.col("key").alias("value"))
    return states.select(F.lit("state").alias("kind"), F.col("epoch").alias("id"), "n", F.col("total").alias("value")).unionByName(undone)


#: For documents with unique ids: the same rule about depths, over whole streams at once.
ORACLE_SQL = f"""
WITH {CRC32_TABLE},
h AS (SELECT doc_id, source, text, {crc32_sql("doc_id::VARCHAR")} AS h FROM documents, crc),
o AS (SELECT doc_id, COALESCE('s' || source, '') AS s, h % 17 AS k, (h // 100) % 30000 AS key, text, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM h),
r AS (SELECT doc_id, s, key, CASE WHEN k <= 1 THEN 'commit' WHEN k = 2 THEN 'abort' WHEN k <= 4 THEN 'savepoint' WHEN k <= 6 THEN 'rollback' ELSE 'change' END AS op, CASE WHEN NOT toxic AND k > 6 THEN {crc32_sql("key || ':' || text")} END AS v FROM o, crc),
t AS (SELECT *, count(*) FILTER (op IN ('commit', 'abort')) OVER (PARTITION BY s ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS txn FROM r),
w AS (SELECT *, COALESCE(sum(CASE op WHEN 'savepoint' THEN 1 WHEN 'rollback' THEN -1 ELSE 0 END) OVER b, 0) AS walk FROM t WINDOW b AS (PARTITION BY s, txn ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, walk - least(0, COALESCE(min(walk - CASE op WHEN 'rollback' THEN 1 ELSE 0 END) OVER (PARTITION BY s, txn ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS depth FROM w),
u AS (SELECT *, min(doc_id) FILTER (op = 'rollback') OVER (PARTITION BY s, txn, depth ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS back FROM g),
e AS (SELECT s, txn, op AS ending, doc_id AS ended, CASE WHEN op = 'commit' THEN row_number() OVER (PARTITION BY op ORDER BY doc_id) END AS number FROM t WHERE op IN ('commit', 'abort')),
c AS (SELECT u.*, CASE WHEN back IS NOT NULL THEN 'rollback' ELSE COALESCE(ending, 'abort') END AS fate, COALESCE(back, ended) AS undoing, (number - 1) // 64 + 1 AS epoch, number FROM u LEFT JOIN e USING (s, txn) WHERE op = 'change'),
l AS (SELECT key, epoch, arg_max({{'v': v}}, (number, doc_id)).v AS v FROM c WHERE fate = 'commit' GROUP BY key, epoch),
m AS (SELECT *, lag({{'v': v}}) OVER (PARTITION BY key ORDER BY epoch) AS old FROM l),
x AS (SELECT epoch, sum((v IS NOT NULL)::INT - (old IS NOT NULL AND old.v IS NOT NULL)::INT) AS n, sum(COALESCE(v, 0) - COALESCE(old.v, 0)) AS total FROM m GROUP BY epoch),
y AS (SELECT DISTINCT (number - 1) // 64 + 1 AS epoch FROM e WHERE ending = 'commit')
SELECT 'state' AS kind, epoch AS id, sum(COALESCE(n, 0)) OVER (ORDER BY epoch)::BIGINT AS n, sum(COALESCE(total, 0)) OVER (ORDER BY epoch)::BIGINT AS value FROM y LEFT JOIN x USING (epoch)
UNION ALL SELECT fate, doc_id, undoing, key FROM c WHERE fate <> 'commit'
"""
