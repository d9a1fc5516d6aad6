"""Scoring predictions against gold: costs by stream order, F1 scores, latency; and trivial baselines.

Everything is grouped by ``run`` beside the stream, so that many predictors are
scored in one plan. Figures come as raw sums and ratios; ``rounded`` rounds
them on the driver as the published reports do.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import labels as L
from talkgrain.functions.text import placeholders
from talkgrain.operators.stream import action_of, rules_of


def prediction_errors(window_ids: Column, raw: Column | None = None) -> Column:
    """Error codes of a prediction row (null: none), in the order of the checks.

    ``raw``: the prediction as VARIANT, where it came from JSON; types that the
    typed columns lose (a boolean among turn ids, a textual confidence) are
    then told apart.
    """
    event, action, rules, ids = F.col("event"), F.col("action"), F.col("policy_rule_ids"), F.col("evidence_turn_ids")
    known = lambda c, values: F.coalesce(c.isin(*values), F.lit(False))
    rules_ok = F.coalesce(F.forall(rules, lambda r: known(r, [rule for rule, _ in K.POLICY_CARD])), F.lit(False))
    if raw is not None:
        kinds = F.transform(F.expr("coalesce(try_variant_get(_raw, '$.evidence_turn_ids', 'array<variant>'), array())"), lambda v: F.schema_of_variant(v))
        present = F.size(kinds) > 0
        integers = F.forall(kinds, lambda k: k == "BIGINT")
        kind = F.expr("schema_of_variant(try_variant_get(_raw, '$.confidence', 'variant'))")
        has_confidence = F.expr("array_contains(json_object_keys(to_json(_raw)), 'confidence')")
        numeric = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        confidence_ok = ~has_confidence | F.coalesce(numeric & F.expr("try_variant_get(_raw, '$.confidence', 'double')").between(0, 1), F.lit(False))
        text = F.expr("to_json(_raw)")
    else:
        present, integers = F.coalesce(F.size(ids) > 0, F.lit(False)), F.coalesce(F.forall(ids, lambda x: x.isNotNull()), F.lit(False))
        confidence_ok = F.coalesce(F.col("confidence").between(0, 1), F.lit(True))
        text = F.to_json(F.struct("benchmark_id", "event", "action", "policy_rule_ids", "evidence_turn_ids"))
    outside = F.coalesce(F.exists(ids, lambda k: ~F.array_contains(window_ids, k)), F.lit(False))
    codes = [
        F.when(~known(event, K.EVENTS), "invalid_event"),
        F.when(~known(action, K.ACTIONS), "invalid_action"),
        F.when(~rules_ok, "invalid_policy_rule_ids"),
        F.when(~present, "invalid_evidence_turn_ids").when(~integers, "non_integer_evidence_turn_id").when(outside, "out_of_window_evidence"),
        F.when(~confidence_ok, "invalid_confidence"),
    ]
    plain = F.filter(F.array(*codes), lambda c: c.isNotNull())
    return F.concat(plain, F.transform(L.output_violations(text), lambda v: F.concat(F.lit("unsafe_output:"), v)))


def set_f1(predicted: Column, gold: Column) -> Column:
    """Of two arrays as sets; two empty ones agree."""
    predicted, gold = (F.array_distinct(F.filter(F.coalesce(x, F.array()), lambda v: v.isNotNull())) for x in (predicted, gold))
    shared, total = F.size(F.array_intersect(predicted, gold)), F.size(predicted) + F.size(gold)
    return F.when(total == 0, 1.0).otherwise(2.0 * shared / total)


def _one_each(rows: DataFrame, keys: list[str], order: str, last: bool) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(F.desc(order) if last else F.asc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _miss_cost(event: Column) -> Column:
    return reduce(lambda out, pair: out.when(event == pair[0], pair[1]), K.MISS_COST.items(), F).otherwise(K.OTHER_MISS_COST)


def scored_items(public: DataFrame, gold: DataFrame, predictions: DataFrame, *, order: str = "ord", raw: bool = False) -> DataFrame:
    """One row an item and run, with its costs; predictions beyond the gold have a null ``gold_action``.

    ``public``: benchmark_id, stream_id, position, window_ids. ``gold``:
    benchmark_id, event, action, policy_rule_ids, evidence_turn_ids.
    ``predictions``: run, the same, optionally confidence and ``raw`` JSON text.
    ``order`` is the place in the file, if a table has it: of items with one id
    the last counts, of predictions the first.
    """
    keyed = lambda df: df if order in df.columns else df.withColumn(order, F.lit(0))
    public = _one_each(keyed(public), ["benchmark_id"], order, True).select("benchmark_id", "stream_id", "position", "window_ids")
    gold = _one_each(keyed(gold), ["benchmark_id"], order, True).select("benchmark_id", *(F.col(c).alias(f"gold_{c}") for c in ("event", "action", "policy_rule_ids", "evidence_turn_ids")))
    runs = predictions.select("run").distinct()
    known = keyed(predictions).where(F.coalesce("benchmark_id", F.lit("")) != "")
    if "confidence" not in known.columns:
        known = known.withColumn("confidence", F.lit(None).cast("double"))
    if raw:
        known = known.withColumn("_raw", F.try_parse_json("raw"))
    first = _one_each(known.withColumn("copies", F.count("*").over(W.partitionBy("run", "benchmark_id"))), ["run", "benchmark_id"], order, False)
    items = gold.join(public, "benchmark_id").crossJoin(F.broadcast(runs))
    rows = items.join(first.withColumn("_predicted", F.lit(True)), ["run", "benchmark_id"], "full")
    predicted, on_gold = F.coalesce("_predicted", F.lit(False)), F.col("gold_action").isNotNull()
    rows = rows.withColumn("errors", F.when(predicted & on_gold, prediction_errors(F.col("window_ids"), F.col("_raw") if raw else None)))
    active = lambda c: F.coalesce(F.col(c).isin(*K.ACTIVE_ACTIONS), F.lit(False))
    rows = rows.withColumn("gold_active", active("gold_action")).withColumn("pred_active", active("action") & predicted & on_gold)
    before = W.partitionBy("run", "stream_id").orderBy("position", "benchmark_id").rowsBetween(W.unboundedPreceding, -1)
    alerted = F.coalesce(F.max("pred_active").over(before), F.lit(False))
    missed = on_gold & F.col("gold_active") & ~F.col("pred_active")
    false = on_gold & ~F.col("gold_active") & F.col("pred_active")
    wrong = on_gold & F.col("gold_active") & F.col("pred_active") & (F.col("action") != F.col("gold_action"))
    bad_evidence = predicted & on_gold & F.coalesce(F.exists("evidence_turn_ids", lambda k: ~F.array_contains("window_ids", k)), F.lit(False))
    invalid = F.coalesce(F.size("errors") > 0, F.lit(False)) | (on_gold & ~predicted)
    cost = lambda flag, amount: F.when(flag, amount).otherwise(0.0)
    rows = rows.select(
        "*", predicted.alias("predicted"), on_gold.alias("on_gold"), missed.alias("missed"), false.alias("false_active"), (false & alerted).alias("duplicate_alert"), bad_evidence.alias("bad_evidence"), invalid.alias("invalid"),
        F.when(predicted & on_gold, set_f1(F.col("evidence_turn_ids"), F.col("gold_evidence_turn_ids"))).alias("evidence_f1"), F.when(predicted & on_gold, set_f1(F.col("policy_rule_ids"), F.col("gold_policy_rule_ids"))).alias("policy_f1"),
        (cost(F.col("_predicted").isNull() & on_gold, K.INVALID_COST) + cost(F.coalesce(F.size("errors") > 0, F.lit(False)), K.INVALID_COST) + F.when(missed, _miss_cost(F.col("gold_event"))).otherwise(0.0) + cost(false, K.FALSE_ACTIVE_COST)
         + cost(false & alerted, K.DUPLICATE_ALERT_COST) + cost(wrong, K.WRONG_ACTION_COST) + cost(bad_evidence, K.BAD_EVIDENCE_COST)).alias("cost"),
    )
    return rows.drop("_predicted", "_raw")


def _streams(items: DataFrame) -> DataFrame:
    """When each stream's first alert was due and came, and what a late one costs."""
    firsts = items.where("on_gold").groupBy("run", "stream_id").agg(F.min(F.when(F.col("gold_active"), F.col("position"))).alias("due"), F.min(F.when(F.col("pred_active"), F.col("position"))).alias("came"))
    late = F.when(F.col("came") > F.col("due"), F.least(F.lit(K.LATE_COST_CAP), (F.col("came") - F.col("due")) * K.LATE_COST_PER_TURN)).otherwise(0.0)
    return firsts.withColumn("late_cost", F.coalesce(late, F.lit(0.0)))


def macro_f1(items: DataFrame, labels: tuple[str, ...], predicted: str, gold: str) -> DataFrame:
    """``run, f1``: the mean over the labels that occur on either side; other predictions only cost recall."""
    pairs = items.where("on_gold AND predicted").select("run", F.col(predicted).alias("_p"), F.col(gold).alias("_g"))
    counted = pairs.groupBy("run", "_p", "_g").agg(F.count("*").alias("n"))
    sides = counted.select("run", "n", F.explode(F.array_distinct(F.array(F.struct(F.col("_p").alias("label")), F.struct(F.col("_g").alias("label"))))).alias("s"), "_p", "_g").where(F.col("s.label").isin(*labels))
    hit = F.coalesce((F.col("_p") == F.col("s.label")) & (F.col("_g") == F.col("s.label")), F.lit(False))
    by_label = sides.groupBy("run", "s.label").agg(F.sum(F.when(hit, 2 * F.col("n")).otherwise(0)).alias("twice"), F.sum(F.when(hit, 2 * F.col("n")).otherwise(F.col("n"))).alias("all"))
    return by_label.groupBy("run").agg(F.avg(F.col("twice") / F.col("all")).alias("f1"))


def latencies(items: DataFrame) -> DataFrame:
    """Turns from the due to the given first alert, over the streams where one came at the due turn or later."""
    streams = _streams(items).where("due IS NOT NULL").withColumn("wait", F.when(F.col("came") >= F.col("due"), F.col("came") - F.col("due")))
    # Places among the waits come from how often each wait occurs: as many rows as there are different waits.
    run = W.partitionBy("run")
    waits = streams.where("wait IS NOT NULL").groupBy("run", "wait").agg(F.count("*").alias("_c"))
    waits = waits.withColumn("_upto", F.sum("_c").over(run.orderBy("wait"))).withColumn("_n", F.sum("_c").over(run))
    at = lambda place: F.min(F.when(F.col("_upto") >= place, F.col("wait"))).cast("double")
    # The nearest rank, halves to even.
    last = at(F.bround((F.col("_n") - 1) * 0.95) + 1)
    median = (at(F.floor((F.col("_n") + 1) / 2)) + at(F.floor(F.col("_n") / 2) + 1)) / 2
    mean = F.sum(F.col("wait") * F.col("_c")) / F.sum("_c")
    ranked = waits.groupBy("run").agg(mean.alias("mean_turn_latency"), median.alias("median_turn_latency"), last.alias("p95_turn_latency"), F.max("wait").alias("max_turn_latency"))
    counted = streams.groupBy("run").agg(F.count("*").alias("scored_stream_count"), F.count_if(F.col("came").isNull()).alias("missed_stream_count"))
    return counted.join(ranked, "run", "left")


def _pairs(labels: tuple[str, ...], name: str, predicted: str, gold: str) -> dict[str, Column]:
    """For each label, how often it is predicted, due, and both."""
    pair = F.col("on_gold") & F.col("predicted")
    out = {}
    for k, label in enumerate(labels):
        p, g = F.coalesce(F.col(predicted) == label, F.lit(False)), F.coalesce(F.col(gold) == label, F.lit(False))
        out |= {f"_{name}{k}p": F.count_if(pair & p), f"_{name}{k}g": F.count_if(pair & g), f"_{name}{k}b": F.count_if(pair & p & g)}
    return out


def _mean_f1(labels: tuple[str, ...], name: str) -> Column:
    """The mean over the labels that occur on either side."""
    sides = [F.col(f"_{name}{k}p") + F.col(f"_{name}{k}g") for k in range(len(labels))]
    each = F.filter(F.array(*[F.when(n > 0, 2.0 * F.col(f"_{name}{k}b") / n) for k, n in enumerate(sides)]), lambda x: x.isNotNull())
    return F.when(F.size(each) > 0, F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.size(each))


def score(public: DataFrame, gold: DataFrame, predictions: DataFrame, *, order: str = "ord", raw: bool = False) -> DataFrame:
    """One row a run: counts, the total cost, and ratios that are not rounded.

    Items are made once: all counts are summed up by stream, then by how long a
    stream's first alert took, among as many rows as there are such times its median and
    percentile are found, and then by run.
    """
    items = scored_items(public, gold, predictions, order=order, raw=raw)
    on_gold, predicted = F.col("on_gold"), F.col("predicted")
    counts = {
        "distinct_predictions": F.count_if("predicted"), "matched_prediction_count": F.count_if(predicted & on_gold), "missing_prediction_count": F.count_if(on_gold & ~predicted), "extra_prediction_count": F.count_if(predicted & ~on_gold),
        "duplicate_prediction_count": F.count_if(F.col("copies") > 1), "missed": F.count_if("missed"), "actionable": F.count_if(on_gold & F.col("gold_active")), "false_active": F.count_if("false_active"), "inactive": F.count_if(on_gold & ~F.col("gold_active")),
        "duplicate_alerts": F.count_if("duplicate_alert"), "missed_recovery": F.count_if(F.col("missed") & (F.col("gold_event") == "recovery_followup_due")), "recovery": F.count_if(F.col("gold_event") == "recovery_followup_due"),
        "invalid_prediction_count": F.count_if(F.col("invalid") & predicted), "_cost": F.sum("cost"), "_evidence": F.sum("evidence_f1"), "_evidence_n": F.count("evidence_f1"), "_policy": F.sum("policy_f1"), "_policy_n": F.count("policy_f1"),
    } | _pairs(K.EVENTS, "event", "event", "gold_event") | _pairs(K.ACTIONS, "action", "action", "gold_action")
    first = lambda flag: F.min(F.when(on_gold & F.col(flag), F.col("position")))
    streams = items.groupBy("run", "stream_id").agg(*[c.alias(k) for k, c in counts.items()], first("gold_active").alias("due"), first("pred_active").alias("came"))
    late = F.when(F.col("came") > F.col("due"), F.least(F.lit(K.LATE_COST_CAP), (F.col("came") - F.col("due")) * K.LATE_COST_PER_TURN)).otherwise(0.0)
    streams = streams.withColumn("_late", F.coalesce(late, F.lit(0.0))).withColumn("wait", F.when(F.col("came") >= F.col("due"), F.col("came") - F.col("due")))
    due = F.col("due").isNotNull()
    more = {"scored_stream_count": F.count_if(due), "missed_stream_count": F.count_if(due & F.col("came").isNull()), "_waits": F.count("wait")}
    sums = [*counts, "_late"]
    waits = streams.groupBy("run", "wait").agg(*[F.sum(k).alias(k) for k in sums], *[c.alias(k) for k, c in more.items()])
    run = W.partitionBy("run")
    waits = waits.withColumn("_upto", F.sum("_waits").over(run.orderBy(F.col("wait").asc_nulls_first()))).withColumn("_n", F.sum("_waits").over(run))
    at = lambda place: F.min(F.when(F.col("wait").isNotNull() & (F.col("_upto") >= place), F.col("wait"))).cast("double")
    # The nearest rank, halves to even.
    found = waits.groupBy("run").agg(
        *[F.sum(k).alias(k) for k in [*sums, "scored_stream_count", "missed_stream_count"]], (F.sum(F.col("wait") * F.col("_waits")) / F.nullif(F.sum("_waits"), F.lit(0))).alias("mean_turn_latency"),
        ((at(F.floor((F.col("_n") + 1) / 2)) + at(F.floor(F.col("_n") / 2) + 1)) / 2).alias("median_turn_latency"), at(F.bround((F.col("_n") - 1) * 0.95) + 1).alias("p95_turn_latency"), F.max("wait").alias("max_turn_latency"),
    )
    mean = lambda name: F.col(f"_{name}") / F.nullif(F.col(f"_{name}_n"), F.lit(0))
    beyond = (F.col("extra_prediction_count") + F.col("duplicate_prediction_count")) * K.INVALID_COST
    out = found.withColumns({
        "evidence_turn_id_set_f1": mean("evidence"), "policy_rule_set_f1": mean("policy"), "event_macro_f1_diagnostic": _mean_f1(K.EVENTS, "event"), "action_macro_f1": _mean_f1(K.ACTIONS, "action"),
        "total_penalty": F.col("_cost") + F.coalesce("_late", F.lit(0.0)) + beyond, "item_count": F.lit(gold.count()),
    })
    return out.withColumn("cost_per_100", 100 * F.col("total_penalty") / F.nullif(F.col("item_count"), F.lit(0))).select(*[c for c in out.columns if not c.startswith("_")], "cost_per_100")


def rounded(row: dict[str, Any]) -> dict[str, Any]:
    """The published figures of a run, from its row: half-even rounding at four places, on the driver."""
    rate = lambda a, b: round(row[a] / b, 4) if b else 0.0
    cost = round(row["cost_per_100"] or 0.0, 4)
    return {
        "SSU": round(100 - min(100.0, cost), 4), "weighted_cost_per_100": cost, "missed_actionable_rate": rate("missed", row["actionable"]), "false_active_rate": rate("false_active", row["inactive"]),
        "duplicate_alert_rate": rate("duplicate_alerts", max(1, row["item_count"])), "missed_recovery_rate": rate("missed_recovery", row["recovery"]), "invalid_prediction_rate": rate("invalid_prediction_count", row["item_count"]),
        "event_macro_f1_diagnostic": round(row["event_macro_f1_diagnostic"] or 0.0, 4), "action_macro_f1": round(row["action_macro_f1"] or 0.0, 4),
    }


def baseline_predictions(public: DataFrame) -> DataFrame:
    """The predictions of all trivial baselines: each item thirteen times, ``run`` names the baseline."""
    window = F.col("input.dialogue_window")
    current = F.element_at(window, -1)
    shuffled = F.array_join(F.array_sort(F.transform(window, lambda t: t["utterance"])), " ")
    cues = public.select("*", F.coalesce(current["utterance"], F.lit("")).alias("_text"), F.to_json(window).alias("_joined"), shuffled.alias("_shuffled"))
    has = lambda array: F.size(array) > 0
    cues = cues.select(
        "benchmark_id", "stream_position", F.size(window).alias("_turns"), (current["speaker"] == "caller").alias("_caller"), current["turn_id"].alias("_turn_id"), has(L.requests(F.col("_text"))).alias("_asks"), has(L.pressure_categories(F.col("_text"))).alias("_presses"),
        has(L.requests(F.col("_joined"))).alias("_asked"), has(L.requests(F.col("_shuffled"))).alias("_asked_shuffled"), placeholders(F.col("_joined")).alias("_seen"),
    )
    asks, quiet, wait = F.lit("new_sensitive_request"), F.lit("no_new_actionable_event"), F.lit("needs_more_context")
    when = lambda condition, event=asks, other=wait: F.when(condition, event).otherwise(other)
    secret = F.arrays_overlap("_seen", F.array(*map(F.lit, ("[MASKED_OTP]", "[MASKED_CREDENTIAL]", "[MASKED_ACCOUNT]"))))
    events = {
        "always_active": asks, "never_active": quiet, "caller_turn_only": when(F.col("_caller"), other=quiet), "position_only": when(F.col("stream_position") >= 3),
        "current_keyword": F.when(F.col("_asks"), asks).when(F.col("_presses"), "pressure_only_monitor").otherwise(wait), "prefix_keyword": when(F.col("_asked")),
        "placeholder_count_or_type": F.when(secret, asks).when(has("_seen"), "pressure_only_monitor").otherwise(wait), "repeat_prior_state": wait, "static_verify": F.lit("pressure_escalation"), "static_refuse": asks,
        "static_preserve_on_any_mask": when(has("_seen"), F.lit("recovery_followup_due")), "window_length_only": when(F.col("_turns") >= 4), "shuffled_dialogue": when(F.col("_asked_shuffled")),
    }
    rows = cues.select("benchmark_id", F.explode(F.array(*[F.struct(F.lit(name).alias("run"), events[name].alias("event")) for name in K.BASELINES])).alias("b"), F.array(F.coalesce("_turn_id", "stream_position")).alias("evidence_turn_ids"))
    event = F.col("b.event")
    return rows.select("b.run", "benchmark_id", event.alias("event"), action_of(event).alias("action"), rules_of(event).alias("policy_rule_ids"), "evidence_turn_ids")


def scorable(public: DataFrame) -> DataFrame:
    """The columns of public items that scoring reads."""
    return public.select("benchmark_id", "stream_id", F.col("stream_position").alias("position"), F.transform("input.dialogue_window", lambda t: t["turn_id"]).alias("window_ids"))


def score_baselines(public: DataFrame, gold: DataFrame) -> DataFrame:
    """All baselines in one plan."""
    return score(scorable(public), gold, baseline_predictions(public))
