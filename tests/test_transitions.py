"""What happens in a stream of turns: along a table, and as turns arrive."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from talkgrain.functions import masking
from talkgrain.operators import quality, stream
from talkgrain.streaming import transitions as online

SAID = (
    (1, 1, "attacker", "은행 보안팀 담당자입니다"), (1, 2, "victim", "무슨 일인가요"), (1, 3, "attacker", "지금 [MASKED_OTP] 인증번호를 입력해 주세요"), (1, 4, "victim", "공식 채널로 직접 확인하겠습니다"), (1, 5, "attacker", "오늘 마감입니다, 즉시 처리하세요"),
    (2, 1, "attacker", "링크로 접속해 주세요 [MASKED_URL]"), (2, 2, "victim", "[MASKED_PHONE] 제공하겠습니다"), (2, 3, "attacker", "감사합니다"), (2, 4, "victim", "네"), (3, 1, "attacker", "안녕하세요"), (3, 2, "victim", "네 안녕하세요"),
)
EVENTS = (
    ("pressure_only_monitor", "monitor_only", 1), ("no_new_actionable_event", "no_alert", 2), ("new_sensitive_request", "refuse_or_pause", 3), ("recipient_containment", "no_alert", 4), ("pressure_escalation", "pause_or_verify", 5),
    ("new_caller_directed_path", "refuse_or_pause", 1), ("recipient_partial_or_direct_disclosure", "preserve_and_report", 2), ("recovery_followup_due", "preserve_and_report", 2), ("recovery_followup_due", "preserve_and_report", 2),
    ("needs_more_context", "monitor_only", 1), ("needs_more_context", "monitor_only", 2),
)


def _told(rows):
    return {(r.stream_id, r.turn_id): (r.event, r.action, r.evidence_turn_ids[0]) for r in rows.collect()}


def test_transitions(spark):
    turns = spark.createDataFrame(SAID, "stream_id int, turn_id int, speaker string, utterance string")
    rows = stream.transitions(turns)
    assert _told(rows) == dict(zip([s[:2] for s in SAID], EVENTS, strict=True)) == _told(stream.transitions(turns, state=False))
    state = rows.where("stream_id = 2 AND turn_id = 4").first().oracle_state
    assert state.prior_request_types == ["caller_directed_link_or_path"] and list(state.prior_direct_disclosure_turn_ids) == [2] and state.current_request_types == []


def test_one_long_stream(spark):
    """A hundred thousand turns of one stream: a turn costs the same wherever it stands."""
    said = F.element_at(F.array(*[F.lit(s[3]) for s in SAID[:5]]), (F.col("id") % 5 + 1).cast("int"))
    turns = spark.range(100_000).select(F.lit("s").alias("stream_id"), (F.col("id") + 1).alias("turn_id"), F.when(F.col("id") % 2 == 0, "attacker").otherwise("victim").alias("speaker"), said.alias("utterance"))
    began = time.time()
    counts = {r.event: r["count"] for r in stream.transitions(turns, state=False).groupBy("event").count().collect()}
    assert sum(counts.values()) == 100_000 and counts["pressure_only_monitor"] == 1 and counts["new_sensitive_request"] <= 5 and time.time() - began < 30
    assert stream.transitions(turns).select(F.sum(F.size("oracle_state.prior_request_types"))).first()[0] > 90_000 and time.time() - began < 60


def _turns(rnd):
    """Turns of forty streams, ten seconds each, in an order in which none comes more than 25 seconds late."""
    rows = [(f"s{k}", t, 1_700_000_000 + 10 * t, "attacker" if t % 2 else "victim", rnd.choice(SAID)[3]) for k in range(40) for t in range(1, rnd.randint(2, 9))]
    rows.append(("s0", 2, 1_700_000_020, "victim", "[MASKED_PHONE] 제공하겠습니다"))  # two turns of one position don't see each other
    return sorted(rows, key=lambda r: r[2] + 25 * rnd.random())


def _frame(spark, rows):
    return spark.createDataFrame(rows, "stream_id string, turn_id bigint, at bigint, speaker string, utterance string").withColumn("at", F.timestamp_seconds("at"))


def test_turns_that_arrive_late(spark, tmp_path):
    """Several batches and a restart give what the table gives; what comes behind the delay is dropped and counted."""
    rows = _turns(random.Random(3))
    wanted = sorted((r.stream_id, r.turn_id, r.event, r.evidence_turn_ids[0]) for r in stream.transitions(_frame(spark, rows).drop("at"), state=False).collect())
    folder, state, out = (str(tmp_path / p) for p in ("in", "state", "out"))
    arrived = lambda: spark.readStream.schema(online.TURNS).option("maxFilesPerTrigger", 1).parquet(folder)
    add = lambda df: df.coalesce(1).write.mode("append").parquet(folder)
    for k in range(4):
        add(_frame(spark, rows[k * len(rows) // 4 : (k + 1) * len(rows) // 4]))
        if k == 1:
            assert online.late_rows(online.run_available(arrived(), state, out, "30 seconds")) == 0
            assert 0 < spark.read.parquet(out).count() < len(rows) // 2  # the others wait, across the restart
    add(online.tick(spark, "2030-01-01 00:00:00"))
    assert online.late_rows(online.run_available(arrived(), state, out, "30 seconds")) == 0
    add(_frame(spark, [("s1", 3, 1_700_000_030, "attacker", "too late"), ("new", 1, 1_700_000_010, "attacker", "too late")]))
    add(online.tick(spark, "2030-01-02 00:00:00"))
    assert online.late_rows(online.run_available(arrived(), state, out, "30 seconds")) == 2
    assert sorted((r.stream_id, r.turn_id, r.event, r.evidence_turn_ids[0]) for r in spark.read.parquet(out).collect()) == wanted


@pytest.mark.parametrize(("turns", "state", "found"), [([], (1, 0, None), []), ([(5, 0, 1, 2, "none"), (5, 0, 2, 0, "direct_masked_disclosure_or_entry"), (6, 0, 0, 0, "none")], (4, 0, 3), [(4, 0, 3), (4, 0, 3), (7, 2, 5)])])
def test_advance(turns, state, found):
    assert [row[-3:] for row in online.advance(state, turns)[1]] == found


def test_masks_and_policy(spark):
    """Names of placeholders that say what they stand for, and what becomes of placeholders."""
    rows = spark.createDataFrame([("[MASKED_TAXPAYER_ID]",), ("[MASKED_ID_NUMBER_2]",), ("[MASKED_HOSPITAL_PHOTO]",), ("[MASKED_X]",), ("[MASKED_PET]",), ("MASKED",)], "p string")
    assert [r.a for r in rows.select(masking.alias_of(F.col("p")).alias("a")).collect()] == ["[MASKED_RRN]", "[MASKED_CASE_REFERENCE]", "[MASKED_ID_IMAGE]", None, "[MASKED_NAME]", None]
    policy = quality.placeholder_policy(rows.select(F.col("p").alias("placeholder"), F.lit(1).alias("n")))
    assert quality.disposition(policy)["[MASKED_PET]"] == "normalize" and quality.disposition(policy)["[MASKED_X]"] == "reject_or_escalate"
