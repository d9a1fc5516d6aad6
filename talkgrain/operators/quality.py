"""The quality report of a corpus: aggregations over records and turns.

Each function gives one table; ``report`` gathers their figures on the driver.
Rates are ratios of counts and are rounded there only.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import labels as L
from talkgrain.functions.masking import alias_of, residual_labels
from talkgrain.functions.text import contains_any, duplicate_key, nonstandard_placeholders, stripped, truncated
from talkgrain.operators.records import attacker_risks, speaker_texts


def value_counts(rows: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """``name, n``, by value; null counts as ``unknown``."""
    c = F.col(column) if isinstance(column, str) else column
    return rows.groupBy(F.coalesce(c.cast("string"), F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))


def duplicate_utterances(turns: DataFrame, text: str = "utterance") -> DataFrame:
    """``duplicates, n``: how many utterances repeat an earlier one's normal form."""
    keys = turns.groupBy(duplicate_key(F.coalesce(text, F.lit(""))).alias("_key")).agg(F.count("*").alias("_n"))
    return keys.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def duplicate_ids(rows: DataFrame, column: str = "id") -> DataFrame:
    named = rows.where(F.col(column).isNotNull() & (stripped(F.col(column).cast("string")) != ""))
    return named.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def mask_counts(records: DataFrame) -> DataFrame:
    return value_counts(records.select(F.explode("safety_masks").alias("m")), F.col("m.label"), "label")


def quality_checks(records: DataFrame, flags: tuple[str, ...] = K.QUALITY_FLAGS) -> DataFrame:
    """``flag, pass, fail, missing``; a typed null is missing."""
    sums = []
    for f in flags:
        c = F.col(f"quality_checks.{f}")
        sums += [F.count_if(c).alias(f"{f}_pass"), F.count_if(~c).alias(f"{f}_fail"), F.count_if(c.isNull()).alias(f"{f}_missing")]
    one = records.agg(*sums)
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), *(F.col(f"{f}_{k}").alias(k) for k in ("pass", "fail", "missing"))) for f in flags])))


def residual_patterns(rows: DataFrame, text: str | Column) -> DataFrame:
    """``label, n``: rows whose text still matches a mask's pattern."""
    c = F.col(text) if isinstance(text, str) else text
    return rows.select(F.explode(residual_labels(c)).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def contexts(records: DataFrame) -> DataFrame:
    """``field, present, missing, distinct``: how the environmental context is filled."""
    context = F.col("gen_metadata.environmental_context")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.when(stripped(context[f]) != "", context[f]).alias("value")) for f in K.CONTEXT_FIELDS])
    return records.select(F.inline(fields)).groupBy("field").agg(F.count("value").alias("present"), F.count_if(F.col("value").isNull()).alias("missing"), F.count_distinct("value").alias("distinct"))


def context_values(records: DataFrame) -> DataFrame:
    context = F.col("gen_metadata.environmental_context")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), context[f].alias("value")) for f in K.CONTEXT_FIELDS])
    return records.select(F.inline(fields)).where(stripped(F.col("value")) != "").groupBy("field", "value").agg(F.count("*").alias("n"))


def risk_coverage(records: DataFrame, defaults: DataFrame) -> DataFrame:
    """``records, mismatches, without_risk``: a scenario's usual risks against those of the attacker's turns.

    ``defaults``: scenario_type, risks; scenarios that it lacks have
    ``voice_impersonation``.
    """
    seen = records.select("scenario_type", attacker_risks(F.col("dialogue")).alias("_seen")).join(defaults.select("scenario_type", F.array_sort(F.array_distinct("risks")).alias("_usual")), "scenario_type", "left")
    usual = F.coalesce("_usual", F.array(F.lit("voice_impersonation")))
    return seen.agg(F.count("*").alias("records"), F.count_if(usual != F.col("_seen")).alias("mismatches"), F.count_if(F.size("_seen") == 0).alias("without_risk"))


def not_attacks(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(F.coalesce(F.col("label") != "attack", F.lit(True))).alias("non_attack_count"))


def cue_turns(turns: DataFrame) -> DataFrame:
    return turns.where("speaker = 'attacker'").withColumn("cues", L.pressure_cues(F.coalesce("utterance", F.lit(""))))


def cue_diversity(turns: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """``attacker_turns, with_cue, urgent`` and ``cue, n, first``; ``first``: the place of the first turn with it, for ties."""
    cued = cue_turns(turns)
    sums = cued.agg(F.count("*").alias("attacker_turns"), F.count_if(F.size("cues") > 0).alias("with_cue"), F.count_if(F.array_contains("cues", "urgency")).alias("urgent"))
    place = F.struct(F.col(order), F.col("_k")) if order in turns.columns else F.col("_k")
    each = cued.select("*", F.posexplode("cues").alias("_k", "cue")).groupBy("cue").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    return sums, each


def style_alignment(records: DataFrame) -> DataFrame:
    """``assigned, matches, urgency_leaks``: the style a record was to have against its attacker's cues."""
    style = F.col("gen_metadata.pressure_style")
    seen = records.where(stripped(style) != "").select(style.alias("_style"), L.pressure_cues(F.array_join(speaker_texts(F.col("dialogue"), "attacker"), " ")).alias("_cues"))
    urgent = F.array_contains("_cues", "urgency")
    return seen.agg(F.count("*").alias("assigned"), F.count_if(F.array_contains("_cues", F.col("_style"))).alias("matches"), F.count_if((F.col("_style") != "urgency") & urgent).alias("urgency_leaks"))


def target_rows(records: DataFrame) -> DataFrame:
    meta = F.col("gen_metadata")
    target = meta["target_outcome_mode"]
    observed = F.coalesce("outcome", F.lit("unknown"))
    repaired = F.coalesce(meta["target_outcome_deterministic_repair_applied"], meta["target_outcome_repair_applied"], F.lit(False))
    rewritten = F.coalesce(meta["target_outcome_llm_rewrite_applied"], F.lit(False))
    rows = records.where(stripped(target) != "").select("*", target.alias("target"), observed.alias("observed"), repaired.alias("repaired"), rewritten.alias("rewritten"), meta["target_outcome_generation_attempts"].alias("attempts"), meta["target_outcome_llm_rewrite_attempts"].alias("rewrites"))
    return rows.withColumn("matches", F.when(F.col("target") == "masked_compromise", F.col("observed") == "compromised").otherwise(F.col("observed") == F.col("target")))


def target_alignment(records: DataFrame) -> DataFrame:
    """``assigned, matches, repaired, rewritten, retried``."""
    retried = F.col("matches") & ~F.col("repaired") & ~F.col("rewritten") & F.coalesce(F.col("attempts") > 1, F.lit(False))
    return target_rows(records).agg(F.count("*").alias("assigned"), F.count_if("matches").alias("matches"), F.count_if("repaired").alias("repaired"), F.count_if("rewritten").alias("rewritten"), F.count_if(retried).alias("retried"))


def signal_turns(turns: DataFrame) -> DataFrame:
    """Each turn's counts: stage directions, masks in odd places, unknown placeholders, partial compliance, entity names."""
    text = F.coalesce("utterance", F.lit(""))
    entities = F.array_sort(F.array_distinct(F.regexp_extract_all(F.regexp_replace(text, K.PLACEHOLDER, ""), F.lit(K.ENTITY), F.lit(0))))
    return turns.select(
        "*", F.regexp_count(text, F.lit(K.STAGE_DIRECTION)).alias("stage_directions"), text.rlike(K.OTP_TRANSFER).alias("odd_mask"), nonstandard_placeholders(text).alias("unknown_placeholders"),
        (F.coalesce(F.col("speaker") == "victim", F.lit(False)) & L.partly_complies(text)).alias("partial_compliance"), entities.alias("entities"),
    )


def signal_counts(turns: DataFrame) -> DataFrame:
    return signal_turns(turns).agg(
        F.coalesce(F.sum("stage_directions"), F.lit(0)).alias("stage_direction_count"), F.count_if("odd_mask").alias("mask_usage_anomaly_count"), F.coalesce(F.sum(F.size("unknown_placeholders")), F.lit(0)).alias("unknown_masked_placeholder_count"),
        F.count_if("partial_compliance").alias("partial_compliance_signal_count"), F.count_if(F.size("entities") > 0).alias("korean_entity_warning_count"),
    )


def examples(turns: DataFrame, condition: Column, *, order: str | Column, limit: int = 10) -> DataFrame:
    """The first few turns of a kind, in the corpus's order: a top-k report."""
    return turns.where(condition).orderBy(order).limit(limit).select("record_id", "turn_id", truncated(F.col("utterance")).alias("utterance"))


def placeholder_policy(counts: DataFrame) -> DataFrame:
    """Adds ``decision, normalize_to, bucket`` to ``placeholder, n``."""
    spark = counts.sparkSession
    known = spark.createDataFrame([(p, d, t) for p, (d, t) in K.PLACEHOLDER_DECISIONS.items()], "placeholder string, _decision string, _to string")
    alias = alias_of(F.col("placeholder"))
    rows = counts.join(F.broadcast(known), "placeholder", "left")
    rows = rows.withColumn("decision", F.coalesce("_decision", F.when(alias.isNotNull(), "normalize_to_existing").otherwise("unclassified_review_required")))
    rows = rows.withColumn("normalize_to", F.when(F.col("_decision").isNotNull(), F.col("_to")).otherwise(alias))
    sensitive = contains_any(F.col("placeholder"), K.SENSITIVE_PARTS)
    bucket = F.when(F.col("decision") == "normalize_to_existing", "normalize").when(sensitive, "reviewed_sensitive").when(F.col("decision") == "allowlist_candidate", "allowlist").otherwise("reject_or_escalate")
    return rows.withColumn("bucket", bucket).drop("_decision", "_to")


def unknown_placeholder_counts(turns: DataFrame, text: str = "utterance") -> DataFrame:
    found = turns.select(F.explode(nonstandard_placeholders(F.coalesce(text, F.lit("")))).alias("placeholder"))
    return found.groupBy("placeholder").agg(F.count("*").alias("n"))


def disposition(policy: DataFrame) -> dict[str, str]:
    """``placeholder -> bucket``, for building items; as many rows as there are kinds of placeholders."""
    return {r.placeholder: r.bucket for r in policy.select("placeholder", "bucket").collect()}


def pair_mismatches(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Records whose scenario is not the one that ``pairs(victim_id, attacker_id, expected)`` has for their personas."""
    keyed = records.select("*", F.col("victim_persona.id").alias("victim_id"), F.col("attacker_persona.id").alias("attacker_id"))
    return keyed.join(pairs, ["victim_id", "attacker_id"]).where(F.coalesce("scenario_type", F.lit("")) != F.col("expected"))


def run_summary(records: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    """``records, fallback_turns, semantic_repair_turns`` and how many records pass each flag."""
    meta = F.col("gen_metadata")
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0))
    return records.agg(F.count("*").alias("records"), total(meta["fallback_turn_ids"]).alias("fallback_turns"), total(meta["semantic_repair_turn_ids"]).alias("semantic_repair_turns"), *(F.count_if(F.col(f"quality_checks.{f}")).alias(f) for f in flags))


def review(duplicate_rate: float, target: dict[str, Any], signals: dict[str, Any], unclassified: int) -> dict[str, Any]:
    """The final gate: reasons for a look at the corpus, in a fixed order."""
    reasons = {
        "target_outcome_alignment_below_final_threshold": target["assigned"] > 0 and target["matches"] < target["assigned"],
        "target_outcome_repair_rate_above_final_threshold": bool(target["assigned"]) and round(target["repaired"] / target["assigned"], 4) > K.MAX_REPAIR_RATE,
        "duplicate_utterance_rate_above_final_threshold": duplicate_rate > K.MAX_DUPLICATE_RATE,
        "stage_direction_present": signals["stage_direction_count"] > 0,
        "unknown_placeholder_unclassified_review_required": unclassified > 0,
    }
    found = [name for name, holds in reasons.items() if holds]
    return {"review_required": bool(found), "reasons": found}


def failed_gates(report: dict[str, Any], contract_failures: int, *, final: bool = False) -> list[str]:
    """Which gates of a run fail: the records' contract always counts, the final review if it is asked for."""
    gates = {"schema_contract": contract_failures > 0, "final_review": final and report["final_review"]["review_required"]}
    return [name for name, failed in gates.items() if failed]


def _record_facts(records: DataFrame, defaults: DataFrame) -> DataFrame:
    """``section, key, n, place``: what each record adds to the figures."""
    usual = defaults.select("scenario_type", F.array_sort(F.array_distinct("risks")).alias("_usual"))
    rows = records.join(usual, "scenario_type", "left")
    meta, seen = F.col("gen_metadata"), attacker_risks(F.col("dialogue"))
    context, style, target = meta["environmental_context"], meta["pressure_style"], meta["target_outcome_mode"]
    named = lambda section, value: F.struct(F.lit(section).alias("section"), F.coalesce(value.cast("string"), F.lit("unknown")).alias("key"), F.lit(1).cast("bigint").alias("n"))
    counted = lambda section, key, n=None: F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), (F.lit(1) if n is None else n).cast("bigint").alias("n"))
    when = lambda condition, fact: F.when(F.coalesce(condition, F.lit(False)), fact)
    flag = lambda c: F.when(c, "pass").when(~c, "fail").otherwise("missing")
    styled, aimed = stripped(style) != "", stripped(target) != ""
    cues = F.when(styled, L.pressure_cues(F.array_join(speaker_texts(F.col("dialogue"), "attacker"), " ")))
    rows = rows.withColumns({"_seen": seen, "_cues": cues})
    observed = F.coalesce("outcome", F.lit("unknown"))
    matches = F.when(target == "masked_compromise", observed == "compromised").otherwise(observed == target)
    repaired = F.coalesce(meta["target_outcome_deterministic_repair_applied"], meta["target_outcome_repair_applied"], F.lit(False))
    rewritten = F.coalesce(meta["target_outcome_llm_rewrite_applied"], F.lit(False))
    facts = [
        counted("corpus", "records"), counted("corpus", "turns", F.greatest(F.size("dialogue"), F.lit(0))), *(named(k, F.col(c)) for k, c in (("label", "label"), ("outcome", "outcome"), ("scenario", "scenario_type"))),
        named("victim", F.col("victim_persona.id")), named("attacker", F.col("attacker_persona.id")), *(named(f"flag {f}", flag(F.col(f"quality_checks.{f}"))) for f in K.QUALITY_FLAGS if "quality_checks" in records.columns),
        counted("risk", "records"), when(F.coalesce("_usual", F.array(F.lit("voice_impersonation"))) != F.col("_seen"), counted("risk", "mismatches")), when(F.size("_seen") == 0, counted("risk", "without_risk")),
        when(F.coalesce(F.col("label") != "attack", F.lit(True)), counted("corpus", "not_attacks")), when(stripped(F.col("id").cast("string")) != "", named("id", F.col("id"))),
        *(F.when(stripped(context[f]) != "", named(f"context {f}", context[f])).otherwise(counted(f"context {f}", "")) for f in K.CONTEXT_FIELDS),
        when(styled, counted("style", "assigned")), when(F.array_contains("_cues", style), counted("style", "matches")), when((style != "urgency") & F.array_contains("_cues", "urgency"), counted("style", "urgency_leaks")),
        when(aimed, counted("target", "assigned")), when(aimed & matches, counted("target", "matches")), when(aimed & repaired, counted("target", "repaired")), when(aimed & rewritten, counted("target", "rewritten")),
        when(aimed & matches & ~repaired & ~rewritten & (meta["target_outcome_generation_attempts"] > 1), counted("target", "retried")),
        when(aimed, named("target mode", target)), when(aimed, named("target observed", observed)), when(aimed & repaired, named("repaired by target", target)), when(aimed & rewritten, named("rewritten by target", target)),
        when(aimed & meta["target_outcome_generation_attempts"].isNotNull(), named("generation attempts", meta["target_outcome_generation_attempts"])), when(aimed & (meta["target_outcome_llm_rewrite_attempts"] > 0), named("rewrite attempts", meta["target_outcome_llm_rewrite_attempts"])),
        when(styled, named("style assigned", style)), when(context.isNotNull(), counted("corpus", "with_context")), *([named("split", F.col("split"))] if "split" in records.columns else []),
    ]
    masks = F.transform(F.coalesce("safety_masks", F.array().cast("array<struct<label:string,placeholder:string>>")), lambda m: named("mask", m["label"]))
    seen_styles = F.transform(F.coalesce("_cues", F.array().cast("array<string>")), lambda c: named("style observed", c))
    return rows.select(F.inline(F.filter(F.concat(F.array(*facts), masks, seen_styles), lambda x: x.isNotNull())))


def _turn_facts(turns: DataFrame) -> DataFrame:
    """The same of each turn; ``place``: where a cue was seen."""
    counted = lambda section, key, n=None: F.struct(F.lit(section).alias("section"), (key if isinstance(key, Column) else F.lit(key)).alias("key"), (F.lit(1) if n is None else n).cast("bigint").alias("n"), F.lit(None).cast("int").alias("at"))
    rows = signal_turns(turns).withColumn("_cues", F.when(F.col("speaker") == "attacker", L.pressure_cues(F.coalesce("utterance", F.lit("")))))
    when = lambda condition, fact: F.when(F.coalesce(condition, F.lit(False)), fact)
    facts = [
        counted("utterance", F.hex(F.xxhash64(duplicate_key(F.coalesce("utterance", F.lit("")))))), when(F.col("speaker") == "attacker", counted("cues", "attacker_turns")), when(F.size("_cues") > 0, counted("cues", "with_cue")), when(F.array_contains("_cues", "urgency"), counted("cues", "urgent")),
        counted("signal", "stage_direction_count", F.col("stage_directions")), when(F.col("odd_mask"), counted("signal", "mask_usage_anomaly_count")), counted("signal", "unknown_masked_placeholder_count", F.size("unknown_placeholders")),
        when(F.col("partial_compliance"), counted("signal", "partial_compliance_signal_count")), when(F.size("entities") > 0, counted("signal", "korean_entity_warning_count")),
    ]
    each = F.concat(
        F.array(*facts), F.transform("unknown_placeholders", lambda p: counted("placeholder", p)),
        F.transform(F.coalesce("_cues", F.array().cast("array<string>")), lambda c, k: F.struct(F.lit("cue").alias("section"), c.alias("key"), F.lit(1).cast("bigint").alias("n"), k.alias("at"))),
    )
    order = "ord" if "ord" in turns.columns else F.struct("record_id", "turn_id")
    told = rows.select((F.col(order) if isinstance(order, str) else order).alias("_order"), F.inline(F.filter(each, lambda x: x.isNotNull())))
    return told.select("section", "key", "n", F.when(F.col("at").isNotNull(), F.struct(F.col("_order").alias("order"), "at")).alias("place"))


def figures(records: DataFrame, turns: DataFrame, defaults: DataFrame) -> DataFrame:
    """``section, key, n, repeats, kinds, first``: every count of the report, from one pass over records and one over turns.

    All counts are sums over one long table. Utterances and ids are as many as
    the corpus has: they come out as one row each section, with how many repeat another one, and ids that do by themselves.
    ``first`` is where a cue was first seen, for ties.
    """
    told = _turn_facts(turns)
    long = _record_facts(records, defaults).withColumn("place", F.lit(None).cast(told.schema["place"].dataType)).unionByName(told)
    each = long.groupBy("section", "key").agg(F.sum("n").alias("n"), F.min("place").alias("first"))
    single = (F.col("section") == "utterance") | ((F.col("section") == "id") & (F.col("n") <= 1))
    named = each.select("section", F.when(single, "").otherwise(F.col("key")).alias("key"), "n", "first")
    return named.groupBy("section", "key").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("repeats"), F.count("*").alias("kinds"), F.min("first").alias("first"))


def _example_kinds() -> Column:
    kinds = {
        "stage_direction_examples": F.col("stage_directions") > 0, "mask_usage_anomaly_examples": F.col("odd_mask"), "unknown_masked_placeholder_examples": F.size("unknown_placeholders") > 0, "partial_compliance_examples": F.col("partial_compliance"),
        "korean_entity_warnings": F.size("entities") > 0,
    }
    return F.filter(F.array(*[F.when(condition, name) for name, condition in kinds.items()]), lambda x: x.isNotNull())


def all_examples(turns: DataFrame, limit: int = 10) -> DataFrame:
    """A top-k report: ``kind, place, record_id, turn_id, utterance``, the first few turns of each kind, all kinds in one pass."""
    order = F.col("ord") if "ord" in turns.columns else F.struct("record_id", "turn_id")
    rows = signal_turns(turns).select(F.explode(_example_kinds()).alias("kind"), order.alias("_order"), "record_id", "turn_id", truncated(F.col("utterance")).alias("utterance"))
    return rows.withColumn("place", F.row_number().over(W.partitionBy("kind").orderBy("_order"))).where(F.col("place") <= limit).drop("_order")


def record_examples(records: DataFrame, limit: int = 10, order: str = "id") -> DataFrame:
    """A top-k report: ``kind, place, record_id, expected, observed``, the first few records of each kind that is not as it was to be, all kinds in one pass."""
    meta = F.col("gen_metadata")
    style, target, context = meta["pressure_style"], meta["target_outcome_mode"], meta["environmental_context"]
    cues, observed = L.pressure_cues(F.array_join(speaker_texts(F.col("dialogue"), "attacker"), " ")), F.coalesce("outcome", F.lit("unknown"))
    expected = F.when(target == "masked_compromise", "compromised").otherwise(target)
    empty = F.filter(F.array(*[F.when(F.coalesce(stripped(context[f]) == "", F.lit(True)), f) for f in K.CONTEXT_FIELDS]), lambda x: x.isNotNull())
    missing = F.when(context.isNull(), "environmental_context").otherwise(F.array_join(empty, ", "))
    kind = lambda condition, name, wanted, seen: F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(name).alias("kind"), wanted.alias("expected"), seen.alias("observed")))
    styled = stripped(style) != ""
    kinds = F.array(
        kind((stripped(target) != "") & (observed != expected), "target_mismatch_examples", expected, observed), kind(styled & ~F.array_contains("_cues", style), "style_mismatch_examples", style, F.array_join(F.array_sort("_cues"), ", ")),
        kind(styled & (style != "urgency") & F.array_contains("_cues", "urgency"), "urgency_leakage_examples", style, F.lit("urgency")), kind(missing != "", "missing_context_examples", F.lit("environmental_context"), missing),
    )
    rows = records.withColumn("_cues", F.when(styled, cues)).select(F.col(order).alias("_order"), F.col("id").alias("record_id"), F.inline(F.filter(kinds, lambda x: x.isNotNull())))
    return rows.withColumn("place", F.row_number().over(W.partitionBy("kind").orderBy("_order", "record_id"))).where(F.col("place") <= limit).drop("_order")


def report(records: DataFrame, turns: DataFrame, defaults: DataFrame) -> dict[str, Any]:
    """All figures of a corpus as one dictionary, rounded at four places: one query for the figures, two for the examples of turns and of records."""
    rate = lambda a, b: round(a / b, 4) if b else 0.0
    found: dict[str, dict[str, Any]] = {}
    for r in figures(records, turns, defaults).collect():
        found.setdefault(r.section, {})[r.key] = r
    number = lambda section, key: found.get(section, {})[key].n if key in found.get(section, {}) else 0
    some = lambda section, keys: {k: number(section, k) for k in keys}
    table = lambda section: {k: r.n for k, r in sorted(found.get(section, {}).items())}
    said = found.get("utterance", {}).get("")
    repeats = {"duplicates": said.repeats if said else 0, "n": said.n if said else 0}
    risk, style = some("risk", ("records", "mismatches", "without_risk")), some("style", ("assigned", "matches", "urgency_leaks"))
    target, cue_sums = some("target", ("assigned", "matches", "repaired", "rewritten", "retried")), some("cues", ("attacker_turns", "with_cue", "urgent"))
    signals: dict[str, Any] = some("signal", ("stage_direction_count", "mask_usage_anomaly_count", "unknown_masked_placeholder_count", "partial_compliance_signal_count", "korean_entity_warning_count"))
    cues = sorted(found.get("cue", {}).values(), key=lambda r: (-r.n, r.first))
    observations = sum(r.n for r in cues)
    flags = {f: some(f"flag {f}", ("pass", "fail", "missing")) for f in K.QUALITY_FLAGS}
    spark = records.sparkSession
    policy = placeholder_policy(spark.createDataFrame([(k, n) for k, n in table("placeholder").items()], "placeholder string, n bigint")).collect() if found.get("placeholder") else []
    shown: dict[str, list] = {name: [] for name in ("stage_direction_examples", "mask_usage_anomaly_examples", "unknown_masked_placeholder_examples", "partial_compliance_examples", "korean_entity_warnings")}
    for r in sorted(all_examples(turns).collect(), key=lambda r: r.place):
        shown[r.kind].append({"record_id": r.record_id, "turn_id": r.turn_id, "utterance": r.utterance})
    for r in sorted(record_examples(records).collect(), key=lambda r: r.place):
        shown.setdefault(r.kind, []).append({"record_id": r.record_id, "expected": r.expected, "observed": r.observed})
    records_shown = {k: shown.pop(k, []) for k in ("target_mismatch_examples", "style_mismatch_examples", "urgency_leakage_examples", "missing_context_examples")}
    n, duplicate_rate, urgent = number("corpus", "records"), rate(repeats["duplicates"], repeats["n"]), rate(cue_sums["urgent"], cue_sums["with_cue"])
    contexts_ = {f: {"present": sum(r.n for k, r in own.items() if k), "missing": own[""].n if "" in own else 0, "distinct": sum(1 for k in own if k)} for f in K.CONTEXT_FIELDS for own in [found.get(f"context {f}", {})]}
    return {
        "record_count": n, "average_turns": round(number("corpus", "turns") / n, 2) if n else 0.0, "duplicate_utterances": repeats["duplicates"], "duplicate_utterance_rate": duplicate_rate,
        "duplicate_record_ids": {k: r for k, r in table("id").items() if k}, "mask_counts": table("mask"), "quality_checks": flags,
        "quality_pass_rate": {k: rate(v["pass"], sum(v.values())) for k, v in flags.items()}, "outcome_distribution": table("outcome"), "label_distribution": table("label"), "scenario_distribution": table("scenario"),
        "victim_distribution": table("victim"), "attacker_distribution": table("attacker"),
        "attack_only_policy": {"pass": (bad := number("corpus", "not_attacks")) == 0, "non_attack_count": bad}, "scenario_risk_coverage": risk | {"mismatch_rate": rate(risk["mismatches"], risk["records"])},
        "pressure_cues": cue_sums | {"category_counts": {r.key: r.n for r in sorted(cues, key=lambda r: r.key)}, "dominant": cues[0].key if cues else "", "dominant_rate": rate(cues[0].n, observations) if cues else 0.0,
                                     "urgency_rate": urgent, "urgency_warning": cue_sums["with_cue"] >= 3 and urgent >= 0.75 and len(cues) <= 2},
        "split_distribution": table("split"), "record_examples": records_shown, "with_context": number("corpus", "with_context"),
        "target_distributions": {k: table(k) for k in ("target mode", "target observed", "repaired by target", "rewritten by target", "generation attempts", "rewrite attempts")}, "style_distributions": {k: table(k) for k in ("style assigned", "style observed")},
        "pressure_style_alignment": style | {"match_rate": rate(style["matches"], style["assigned"]), "urgency_leakage_rate": rate(style["urgency_leaks"], style["assigned"])},
        "target_outcome_alignment": target | {"match_rate": rate(target["matches"], target["assigned"]), "repair_rate": rate(target["repaired"], target["assigned"])}, "quality_signals": signals | shown,
        "environmental_context": contexts_, "placeholder_policy": {r.placeholder: {"count": r.n, "decision": r.decision, "bucket": r.bucket} for r in sorted(policy, key=lambda r: r.placeholder)},
        "final_review": review(duplicate_rate, target, signals, sum(r.n for r in policy if r.decision == "unclassified_review_required")),
    }


def ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """Adds ``ord``, by which first-seen ties and first-few examples go: the values of ``keys``, which need no global numbering."""
    return rows.withColumn("ord", F.struct(*keys))


def most_common(rows: DataFrame, column: str, *, order: str, limit: int = 20) -> DataFrame:
    """A top-k report: ``column, n, first``, the most frequent values, of equals the one that came first."""
    counted = rows.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(limit)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
