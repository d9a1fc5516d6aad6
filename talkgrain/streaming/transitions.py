"""The online twin of ``stream.transitions``: what happens in each turn, with what came before kept in a state store.

What a turn's words say is computed by columns; the state of a stream is three
numbers (bits of earlier requests and pressures, the last disclosure) and a buffer
of turns that wait for their time. A turn waits until the watermark has passed its
event time; then no earlier one can come any more, and all that wait are taken in
order of position. So turns that come late, but within the delay, take their place, and
later ones are dropped by Spark and counted (``late_rows``). Event times grow with
positions; turns of one position don't see each other.

A stream that stops leaves its last turns waiting for the watermark. A row with a null
stream is a tick: it has a time, which moves the watermark on, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from talkgrain.operators.stream import decided, signs

#: The state store that keeps several variables and timers of a key.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TURNS = "stream_id string, turn_id bigint, at timestamp, speaker string, utterance string"
_SIGNS = "turn_id bigint, at bigint, _requests int, _pressures int, _disclosure string, _defense string, _caller boolean, _path boolean"
_FIELDS = ("turn_id", "at", "_requests", "_pressures", "_disclosure", "_defense", "_caller", "_path")
_OUTPUT = f"stream_id string, {_SIGNS}, _before_requests int, _before_pressures int, _last bigint"
_COLUMNS = ("stream_id", *_FIELDS, "_before_requests", "_before_pressures", "_last")
_DIRECT = "direct_masked_disclosure_or_entry"


def advance(state: tuple[int, int, int | None], turns: list[tuple]) -> tuple[tuple[int, int, int | None], list[tuple]]:
    """The state behind turns that stand in order, and each turn with the state that it found."""
    requests, pressures, last = state
    found, here = [], state
    for k, turn in enumerate(turns):
        if k == 0 or turn[0] != turns[k - 1][0]:
            here = (requests, pressures, last)
        found.append((*turn, *here))
        requests, pressures = requests | turn[2], pressures | turn[3]
        if turn[4] == _DIRECT:
            last = turn[0] if last is None else max(last, turn[0])
    return (requests, pressures, last), found


class Transitions(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.requests = handle.getValueState("requests", "bits int")
        self.pressures = handle.getValueState("pressures", "bits int")
        self.last = handle.getValueState("last", "turn_id bigint")
        self.waiting = handle.getListState("waiting", _SIGNS)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        if key[0] is not None:
            came = [tuple(r[f] for f in _FIELDS) for r in rows]
            self.waiting.appendList(came)
            for at in sorted({turn[1] for turn in came}):
                self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        kept = [tuple(r) for r in self.waiting.get()]
        due = sorted((t for t in kept if t[1] <= now), key=lambda t: (t[0], t[1]))
        if not due:
            return
        if len(due) < len(kept):
            self.waiting.put([t for t in kept if t[1] > now])
        else:
            self.waiting.clear()
        value = lambda state, default: state.get()[0] if state.exists() else default
        (requests, pressures, last), found = advance((value(self.requests, 0), value(self.pressures, 0), value(self.last, None)), due)
        self.requests.update((requests,))
        self.pressures.update((pressures,))
        if last is not None:
            self.last.update((last,))
        for row in found:
            yield Row(**dict(zip(_COLUMNS, (*key, *row), strict=True)))

    def close(self) -> None:
        pass


def transitions(turns: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """For a streaming table of ``TURNS``: ``stream_id, turn_id, event, action, policy_rule_ids, evidence_turn_ids``."""
    rows = signs(turns.withWatermark("at", delay)).withColumn("_at", F.unix_millis("at"))
    # The watermark goes by the time column itself; state and timers count its milliseconds.
    rows = rows.select("stream_id", "turn_id", F.col("_at").alias("at"), *_FIELDS[2:], F.col("at").alias("_time"))
    found = rows.groupBy("stream_id").transformWithState(Transitions(), _OUTPUT, "append", "eventTime")
    return decided(found).select("stream_id", "turn_id", "event", "action", "policy_rule_ids", "evidence_turn_ids")


def run_available(turns: DataFrame, checkpoint: str, out: str, delay: str = "10 seconds") -> StreamingQuery:
    """Process what is there and stop; ``checkpoint`` carries state, waiting turns and the watermark to the next run."""
    spark, key = turns.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        query = transitions(turns, delay).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(key, before)
    return query


def late_rows(query: StreamingQuery) -> int:
    """How many turns of a run came behind the watermark and were dropped."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def tick(spark: SparkSession, at: str) -> DataFrame:
    """A row that moves the watermark to ``at``, less the delay."""
    return spark.createDataFrame([(None, None, at, None, None)], "stream_id string, turn_id bigint, at string, speaker string, utterance string").withColumn("at", F.to_timestamp("at"))
