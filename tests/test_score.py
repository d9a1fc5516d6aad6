"""Scoring: closed forms of the published runs, and each rule of the costs."""

from __future__ import annotations

import pytest

from talkgrain import constants as K
from talkgrain.operators import score, stream

ITEM = "benchmark_id string, stream_id string, position int, window_ids array<int>"
LABEL = "benchmark_id string, event string, action string, policy_rule_ids array<string>, evidence_turn_ids array<int>"


def tables(spark, gold, predictions):
    """``gold``: (stream, position, event). ``predictions``: (stream, position, event, evidence)."""
    public = spark.createDataFrame([(f"{s}/{p}", s, p, list(range(max(1, p - 5), p + 1))) for s, p, _ in gold], ITEM)
    truth = spark.createDataFrame([(f"{s}/{p}", e, K.EVENT_ACTION[e], list(K.EVENT_RULES[e]), [p]) for s, p, e in gold], LABEL)
    rows = [("r", k, f"{s}/{p}", e, K.EVENT_ACTION.get(e, "none"), list(K.EVENT_RULES.get(e, ("P_MONITOR",))), ev) for k, (s, p, e, ev) in enumerate(predictions)]
    return public, truth, spark.createDataFrame(rows, "run string, ord int, " + LABEL)


def figures(spark, gold, predictions):
    return score.score(*tables(spark, gold, predictions)).first().asDict()


QUIET, ASK, DISC, PRESS = "no_new_actionable_event", "new_sensitive_request", "recipient_partial_or_direct_disclosure", "pressure_escalation"


@pytest.mark.parametrize(
    ("gold", "predicted", "cost"),
    [
        ([("a", 1, QUIET)], [("a", 1, QUIET, [1])], 0.0),
        ([("a", 1, ASK)], [], 2.0 + 3.0),
        ([("a", 1, DISC)], [("a", 1, QUIET, [1])], 5.0),
        ([("a", 1, QUIET), ("a", 2, QUIET)], [("a", 1, ASK, [1]), ("a", 2, ASK, [2])], 2.0 + 3.0),
        ([("a", 1, ASK), ("a", 2, ASK)], [("a", 1, ASK, [1]), ("a", 2, ASK, [2])], 0.0),
        ([("a", 1, ASK)], [("a", 1, PRESS, [1])], 1.0),
        ([("a", 1, QUIET)], [("a", 1, QUIET, [9])], 3.0),
        ([("a", 1, QUIET)], [("a", 1, "nonsense", [1])], 2.0),
        ([("a", 1, QUIET)], [("a", 1, QUIET, [1]), ("a", 1, QUIET, [1])], 2.0),
        ([("a", 1, QUIET)], [("a", 1, QUIET, [1]), ("b", 7, QUIET, [7])], 2.0),
        ([("a", 1, ASK), ("a", 2, ASK), ("a", 3, ASK)], [("a", 1, QUIET, [1]), ("a", 2, QUIET, [2]), ("a", 3, ASK, [3])], 3.0 + 3.0 + 1.0),
    ],
)
def test_costs(spark, gold, predicted, cost):
    public, truth, predictions = tables(spark, gold, predicted or [("z", 9, QUIET, [9])])
    extra = 0.0 if predicted else 2.0
    assert score.score(public, truth, predictions).first()["total_penalty"] == cost + extra


#: Streams, then items by event and action of the published runs.
PUBLISHED = (
    (288, {("new_caller_directed_path", "refuse_or_pause"): 58, (ASK, "refuse_or_pause"): 231, (PRESS, "pause_or_verify"): 57, (DISC, "preserve_and_report"): 58, ("recovery_followup_due", "preserve_and_report"): 116, (QUIET, "no_alert"): 1784}, 82.8125, 229.8177),
    (300, {("new_caller_directed_path", "refuse_or_pause"): 60, (ASK, "refuse_or_pause"): 240, (PRESS, "pause_or_verify"): 60, (DISC, "preserve_and_report"): 60, ("recovery_followup_due", "preserve_and_report"): 120, (QUIET, "no_alert"): 1860}, 82.5, 230.0),
)


@pytest.mark.parametrize(("n_streams", "counts", "never", "always"), PUBLISHED)
def test_published_costs(spark, n_streams, counts, never, always):
    labels = [e for e, n in counts.items() for _ in range(n)]
    gold = [(f"s{k % n_streams:03d}", k // n_streams + 1, e, a) for k, (e, a) in enumerate(labels[::-1])]
    public = spark.createDataFrame([(f"{s}/{p}", s, p, [p]) for s, p, _, _ in gold], ITEM)
    truth = spark.createDataFrame([(f"{s}/{p}", e, a, list(K.EVENT_RULES[e]), [p]) for s, p, e, a in gold], LABEL)
    rows = [(run, f"{s}/{p}", e, K.EVENT_ACTION[e], list(K.EVENT_RULES[e]), [p]) for run, e in (("never", QUIET), ("always", ASK)) for s, p, _, _ in gold]
    found = {r["run"]: score.rounded(r.asDict()) for r in score.score(public, truth, spark.createDataFrame(rows, "run string, " + LABEL)).collect()}
    assert found["never"]["weighted_cost_per_100"] == never and found["always"]["weighted_cost_per_100"] == always
    assert found["never"]["SSU"] == round(100 - never, 4) and found["always"]["SSU"] == 0.0


def test_f1(spark):
    items = spark.createDataFrame([("r", True, True, "a", "a"), ("r", True, True, "b", "a"), ("r", True, True, "x", "b"), ("r", True, False, None, "b")], "run string, on_gold boolean, predicted boolean, p string, g string")
    assert score.macro_f1(items, ("a", "b", "c"), "p", "g").first().f1 == pytest.approx((2 / 3 + 0) / 2)
    sets = spark.createDataFrame([([], []), ([1], []), ([1, 2, 2], [2, 3])], "a array<int>, b array<int>")
    from pyspark.sql import functions as F

    assert [r.f for r in sets.select(score.set_f1(F.col("a"), F.col("b")).alias("f")).collect()] == [1.0, 0.0, 0.5]


def test_latency_rank(spark):
    gold = [(f"s{k:02d}", p, ASK if p == 1 else QUIET) for k in range(20) for p in range(1, 7)]
    predicted = [(f"s{k:02d}", p, ASK if p == 1 + k % 6 else QUIET, [p]) for k in range(19) for p in range(1, 7)]
    r = score.latencies(score.scored_items(*tables(spark, gold, predicted))).first()
    waits = sorted(k % 6 for k in range(19))
    assert (r.scored_stream_count, r.missed_stream_count, r.p95_turn_latency, r.max_turn_latency) == (20, 1, float(waits[round(18 * 0.95)]), 5)


def test_raw_types(spark):
    public, truth, _ = tables(spark, [("a", 1, QUIET)], [("a", 1, QUIET, [1])])
    good = '{"benchmark_id":"a/1","event":"no_new_actionable_event","action":"no_alert","policy_rule_ids":["P_MONITOR"],"evidence_turn_ids":%s%s}'
    cases = [("ok", good % ("[1]", ',"confidence":0.5')), ("bool", good % ("[true]", "")), ("far", good % ("[1]", ',"confidence":2')), ("text", good % ("[1]", ',"confidence":"x"')), ("empty", good % ("[]", ""))]
    rows = spark.createDataFrame(cases, "run string, raw string").selectExpr("run", "raw", "from_json(raw, 'benchmark_id string, event string, action string, policy_rule_ids array<string>, evidence_turn_ids array<int>, confidence double') j").selectExpr("run", "raw", "j.*")
    found = {r.run: r.errors for r in score.scored_items(public, truth, rows, raw=True).collect()}
    assert found == {"ok": [], "bool": ["non_integer_evidence_turn_id"], "far": ["invalid_confidence"], "text": ["invalid_confidence"], "empty": ["invalid_evidence_turn_ids"]}


def test_sliding_windows(spark):
    turns = spark.createDataFrame([("a", k, "x", f"u{k}") for k in range(1, 9)], "stream_id string, turn_id int, speaker string, utterance string")
    rows = stream.sliding_windows(turns, stream="stream_id", position="turn_id", fields=("speaker", "utterance")).orderBy("turn_id").collect()
    assert [len(r.window) for r in rows] == [1, 2, 3, 4, 5, 6, 6, 6] and rows[-1].window[0].turn_id == 3
