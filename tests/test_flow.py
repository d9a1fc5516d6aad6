"""From a schedule to records, items, scores and reports, with neutral filler text."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain import rule_queries
from talkgrain.operators import quality, records, score, shortcuts, stream, validate
from talkgrain.plans import schedule, turns
from talkgrain.sources import config, jsonl
from talkgrain.streaming import alerts


@pytest.fixture(scope="module")
def catalogs(spark):
    people = lambda p: spark.createDataFrame([(k, f"{p}{k}") for k in range(3)], "pos int, id string")
    return people("v"), people("a"), spark.createDataFrame([(0, "one"), (1, "pair_only"), (2, "two")], "pos int, scenario string")


def test_schedule(spark, catalogs):
    victims, attackers, scenarios = catalogs
    pairs = spark.createDataFrame([("v1", "a1", "pair_only"), ("v2", "a2", "not configured")], "victim_id string, attacker_id string, preferred string")
    prefs = spark.createDataFrame([("a0", "two"), ("a2", "pair_only")], "id string, preferred string")
    rows = schedule.schedule(spark, victims, attackers, scenarios, count=6, pair_scenarios=pairs, attacker_scenarios=prefs, pair_only=("pair_only",)).orderBy("index").collect()
    assert [(r.victim_id, r.attacker_id) for r in rows] == [("v0", "a0"), ("v1", "a1"), ("v2", "a2"), ("v0", "a1"), ("v1", "a2"), ("v2", "a0")]
    assert [r.scenario_type for r in rows] == ["two", "pair_only", "two", "one", "two", "two"]
    fixed = schedule.schedule(spark, victims, attackers, scenarios, count=7, mode="canonical_repeat").orderBy("index").collect()
    assert [(r.canonical_pair_index, r.variant_index, r.target_outcome_mode) for r in fixed[2:5]] == [(2, 0, "masked_compromise"), (0, 1, "defended_success"), (1, 1, "inconclusive")]
    assert schedule.attempt_limit(5, 1, 3, 3) == 24


def test_planned_actions(spark):
    """The published counts of three hundred varied plans, and of canonical ones."""
    rows = [(str(k), K.PROFILES[k % 5], v, ("money_transfer", "other")[k % 2]) for k in range(300) for v in (str(k // 5 % 6), "canonical")]
    planned = turns.planned_turns(spark.createDataFrame(rows, "record_id string, profile string, variant string, goal string"))
    counts = {(r.kind, r.value): r.n for r in planned.select((planned.variant == "canonical").alias("kind"), F.explode(F.array("event", "action")).alias("value")).groupBy("kind", "value").agg(F.count("*").alias("n")).collect()}
    varied = {v: n for (canonical, v), n in counts.items() if not canonical}
    assert {v: varied[v] for v in K.EVENTS} == {
        "needs_more_context": 710, "new_caller_directed_path": 100, "new_sensitive_request": 240, "no_new_actionable_event": 550, "pressure_escalation": 120, "pressure_only_monitor": 210, "recipient_containment": 290,
        "recipient_partial_or_direct_disclosure": 60, "recovery_followup_due": 120,
    }
    assert {v: varied[v] for v in ("monitor_only", "no_alert", "preserve_and_report")} == {"monitor_only": 1060, "no_alert": 670, "preserve_and_report": 110}
    assert varied["pause_or_verify"] + varied["refuse_or_pause"] == 253 + 307
    assert {v: counts[True, v] for v in K.ACTIONS} == {"monitor_only": 1020, "no_alert": 840, "pause_or_verify": 60, "preserve_and_report": 180, "refuse_or_pause": 300}


@pytest.fixture(scope="module")
def corpus(spark):
    """Sixty records: five profiles, six variants, two goals; every turn has filler text of its own."""
    rows = [(f"r{k:03d}", K.PROFILES[k % 5], str(k // 5 % 6), ("money_transfer", "credential_capture")[k % 2]) for k in range(60)]
    planned = turns.planned_turns(spark.createDataFrame(rows, "record_id string, profile string, variant string, goal string"))
    word = F.concat(F.lit("차분한 안내 문장입니다 번호 "), F.col("record_id"), F.lit(" "), F.col("turn_id").cast("string"), F.coalesce(F.concat(F.lit(" "), F.col("placeholder")), F.lit("")))
    masks = F.when(F.col("placeholder").isNotNull(), F.array(F.struct(F.lower(F.regexp_extract("placeholder", "MASKED_(\\w+)", 1)).alias("label"), F.col("placeholder").alias("placeholder")))).otherwise(F.array().cast("array<struct<label:string,placeholder:string>>"))
    turn = F.struct(
        F.col("turn_id").cast("int").alias("turn_id"), "speaker", "phase", word.alias("utterance"), F.lit("x").alias("intent_label"), F.when(F.col("speaker") == "attacker", "urgency").otherwise("victim_resistance").alias("risk_signal"), masks.alias("masked_items"),
        F.col("event").alias("stream_event"), F.col("action").alias("stream_action"), F.col("policy_rule_ids").alias("stream_policy_rule_ids"), F.col("evidence_turn_ids").alias("stream_evidence_turn_ids"),
    )
    rows = planned.groupBy("record_id", "profile", "variant").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"))
    person = lambda p: F.struct(F.lit(p).alias("id"), F.lit("n").alias("name"), F.lit("d").alias("description"))
    flags = F.struct(F.lit(8).alias("turn_count"), *[F.lit(True).alias(f) for f in K.QUALITY_FLAGS])
    context = F.struct(*[F.lit("c").alias(f) for f in K.CONTEXT_FIELDS])
    meta = F.struct(F.lit("m").alias("attacker_model"), F.lit("m").alias("victim_model"), F.lit("1").alias("prompt_version"), context.alias("environmental_context"), F.lit("defended_success").alias("target_outcome_mode"), F.lit("urgency").alias("pressure_style"), F.col("profile").alias("stream_profile"), F.col("variant").alias("trajectory_variant"), F.array(F.lit(1)).alias("fallback_turn_ids"))
    return rows.select(
        F.col("record_id").alias("id"), F.lit("set").alias("dataset_name"), F.lit("attack").alias("label"), F.lit("one").alias("scenario_type"), person("v").alias("victim_persona"), person("a").alias("attacker_persona"), F.array(F.lit("otp")).alias("protected_assets"),
        F.lit("g").alias("attacker_goal"), F.lit("defended_success").alias("outcome"), F.array().cast("array<string>").alias("compromised_assets"), F.struct(F.lit("low").alias("attacker_sophistication"), F.lit("low").alias("victim_susceptibility")).alias("difficulty"), F.lit("phone").alias("channel"),
        F.lit("ko-KR").alias("locale"), F.lit("train").alias("split"), F.lit("c").alias("context"), "dialogue", F.array(F.lit("urgency")).alias("risk_labels"), records.safety_masks(F.col("dialogue")).alias("safety_masks"), meta.alias("gen_metadata"), flags.alias("quality_checks"),
    )


@pytest.fixture(scope="module")
def stored(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flow") / "records.jsonl")
    jsonl.write_records(corpus, path)
    return path


def test_round_trip_and_contract(spark, stored):
    read = jsonl.read_records(spark, stored)
    assert read.count() == 60 and jsonl.existing_ids(spark, stored).count() == 60 and jsonl.existing_ids(spark, stored + ".none").count() == 0
    line = json.loads(spark.read.text(stored).first()[0])
    assert list(line) == sorted(line) and list(line["dialogue"][0]) == sorted(line["dialogue"][0])
    good, bad = validate.contract(jsonl.read_raw(spark, stored), risk_labels=("urgency",))
    assert (good.count(), bad.count()) == (60, 0)


def _errors(spark, *records_):
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records_)], "k int, line string").withColumn("raw", F.parse_json("line"))
    return [r.e for r in df.select("k", validate.record_error(max_turns=10, risk_labels=("urgency",)).alias("e")).orderBy("k").collect()]


def test_contract_errors(spark, stored):
    good = json.loads(spark.read.text(stored).first()[0])

    def changed(path, value):
        out = json.loads(json.dumps(good))
        *way, last = path
        place = out
        for step in way:
            place = place[step]
        if value is KeyError:
            del place[last]
        else:
            place[last] = value
        return out

    cases = {
        "Missing record fields: ['label', 'split']": {k: v for k, v in good.items() if k not in ("label", "split")},
        "dialogue must be a non-empty list": changed(["dialogue"], []), "dialogue exceeds max_turns=10": changed(["dialogue"], good["dialogue"] * 2), "Invalid label: other": changed(["label"], "other"), "Unknown risk_labels: ['x']": changed(["risk_labels"], ["x"]),
        "risk_labels entries must be non-empty strings": changed(["risk_labels"], [1]), "safety_masks must be a list": changed(["safety_masks"], None), "safety_masks must not expose original sensitive values": changed(["safety_masks"], [{"label": "a", "placeholder": "b", "original": "c"}]),
        "safety_masks[0] is missing placeholder": changed(["safety_masks"], [{"label": "a"}]), "gen_metadata.environmental_context is missing fields: ['timing']": changed(["gen_metadata", "environmental_context", "timing"], KeyError),
        "gen_metadata.environmental_context.timing must be a non-empty string": changed(["gen_metadata", "environmental_context", "timing"], " "), "Missing turn fields at 2: ['phase']": changed(["dialogue", 1, "phase"], KeyError),
        "turn_id mismatch at turn 1": changed(["dialogue", 0, "turn_id"], 5), "Unexpected speaker order at turn 2: attacker": changed(["dialogue", 1, "speaker"], "attacker"), "quality_checks.turn_count must match dialogue length": changed(["quality_checks", "turn_count"], 7),
        "quality_checks.turn_count must be an integer": changed(["quality_checks", "turn_count"], True), "quality_checks.schema_valid must be a boolean": changed(["quality_checks", "schema_valid"], 1), "Missing quality check: safety_passed": changed(["quality_checks", "safety_passed"], KeyError),
    }
    assert _errors(spark, good, *cases.values()) == [None, *cases]


def test_contract_is_checked_once(spark, stored):
    """Filters on the error do not make the rules, or the JSON they read, again; the work of a table of one block is dealt out."""
    raw = spark.read.text(stored).select(F.parse_json("value").alias("raw"))
    good, bad = validate.contract(raw)
    assert (good.count(), bad.count(), good.columns) == (raw.count(), 0, ["raw"])
    plan = good.agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("Filter") == 1
    lines = rule_queries.contract_errors(spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in lines._jdf.queryExecution().executedPlan().toString()


def test_items_scores_and_reports(spark, stored):
    corpus = jsonl.read_records(spark, stored).persist()
    items = {k: df.persist() for k, df in stream.build_planned_items(corpus, {}).items()}
    assert items["public"].count() == 480 and items["rejected"].count() == 0 and not stream.forbidden_keys(items["public"]) and "id" in stream.forbidden_keys(corpus)
    found = {(r.metric, r.key): r.n for r in stream.yield_counts(items).collect()}
    assert found["event_distribution", "needs_more_context"] == 142 and found["event_distribution", "recovery_followup_due"] == 24 and found["stream_count", ""] == 60
    scores = {r["run"]: score.rounded(r.asDict()) for r in score.score_baselines(items["public"], items["gold"]).collect()}
    assert set(scores) == set(K.BASELINES) and scores["never_active"]["missed_actionable_rate"] == 1.0 and scores["always_active"] == scores["static_refuse"] and scores["always_active"]["false_active_rate"] == 1.0
    report = shortcuts.shortcut_report(items["public"], items["manifest"], items["gold"], items["rejected"])
    assert report["profile_unique_event_sequence_counts"] == {"benign_thin_context": 6, "caller_directed_path": 6, "partial_disclosure_recovery": 5, "pressure_escalation": 6, "safe_containment": 6}
    assert report["fallback_turn_count"] == 60 and report["profile_position_majority_event_accuracy"] == 0.75 and len(report["gate_checks"]) == 15
    told = quality.ordered(records.turns(corpus.select(F.col("id").alias("record_id"), "dialogue")), "record_id", "place")
    defaults = spark.createDataFrame([("one", ["urgency"])], "scenario_type string, risks array<string>")
    qa = quality.report(corpus, told, defaults)
    assert qa["record_count"] == 60 and qa["duplicate_utterances"] == 0 and qa["scenario_risk_coverage"]["mismatches"] == 0 and qa["target_outcome_alignment"]["match_rate"] == 1.0 and not qa["final_review"]["review_required"]
    assert "# qa" in jsonl.markdown("qa", qa)


def test_observed_items(spark, stored):
    corpus = jsonl.read_records(spark, stored)
    odd = corpus.limit(2).withColumn("id", F.concat(F.lit("odd"), "id")).withColumn("dialogue", F.transform("dialogue", lambda t: t.withField("utterance", F.lit("[sighs] text"))))
    items = stream.build_observed_items(corpus.unionByName(odd), {})
    assert items["gold"].count() == 480 and {r.reason: r["count"] for r in items["rejected"].groupBy("reason").count().collect()} == {"stage_direction_or_unmasked_bracket": 2}
    assert items["gold"].where("action IS NULL OR size(evidence_turn_ids) = 0").count() == 0


def test_append_and_side_channel(spark, tmp_path):
    path = str(tmp_path / "out.jsonl")
    rows = lambda *ids: spark.createDataFrame([(i, None) for i in ids], "id string, note string")
    jsonl.append_new(rows("a", "b"), path)
    assert sorted(r.id for r in jsonl.append_new(rows("b", "c"), path).collect()) == [] or jsonl.existing_ids(spark, path).count() == 3
    assert jsonl.errors_path("/x/run.jsonl") == "/x/run.errors.jsonl"
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"a": 1}\n\nnot json\n')
    good, errors = jsonl.read_with_errors(spark, str(bad))
    assert (good.count(), errors.count()) == (1, 1)
    array = tmp_path / "list.json"
    array.write_text('[{"id": "x"}, {"id": "y"}]')
    assert [(r.pos, r.id) for r in jsonl.read_array(spark, str(array), "id string").collect()] == [(0, "x"), (1, "y")]
    assert jsonl.count_hint("run_260609_120_vllm.jsonl")["count_hint"] == 120


def test_config(tmp_path):
    (tmp_path / "configs").mkdir()
    path = tmp_path / "configs" / "c.json"
    path.write_text(json.dumps({"dataset_name": "d", "scenario_types": ["a", "b"], "risk_labels": ["r"], "victims_path": "data/v.json", "other": 1}))
    loaded = config.load_config(str(path))
    assert loaded.victims_path == str(tmp_path / "data" / "v.json") and loaded.extra == {"other": 1}
    with pytest.raises(ValueError, match="twice"):
        config.Config("d", ("a", "a"), ("r",))
    with pytest.raises(ValueError, match="repeated ids"):
        config.check_personas([{"id": "x", "goals": ["g"]}] * 2, ("goals",), 5)


def test_stream_keeps_state_between_batches(spark, tmp_path):
    shape = "stream_id string, position long, active boolean"
    folder, state, out = (str(tmp_path / p) for p in ("in", "state", "out"))
    for batch in ([("a", 1, False), ("a", 2, True), ("b", 1, True)], [("a", 3, False), ("a", 1, True), ("b", 2, False)]):
        alerts.replay(spark.createDataFrame(batch, shape), folder)
        alerts.run_available(spark.readStream.schema(shape).parquet(folder), state, out)
    rows = {(r.stream_id, r.position): (r.prior_alert, r.first_alert) for r in spark.read.parquet(out).where("NOT late").collect()}
    assert [(r.stream_id, r.position, r.active, r.prior_alert, r.first_alert, r.late_dropped) for r in spark.read.parquet(out).where("late").collect()] == [("a", 1, True, None, None, 1)]
    assert rows == {("a", 1): (False, None), ("a", 2): (False, None), ("b", 1): (False, None), ("a", 3): (True, 2), ("b", 2): (True, 1)}
