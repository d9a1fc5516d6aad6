"""Unrolling records into decision items: one for each turn, with a bounded window of what was said."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import labels as L
from talkgrain.functions.ids import stable_id
from talkgrain.functions.text import contains_any, placeholders, surface_text
from talkgrain.operators.records import has_bracket

DIRECT = "direct_masked_disclosure_or_entry"


def public_turns(dialogue: Column, surface: str = "typed_raw", upto: Column | None = None) -> Column:
    """Turns as a reader may see them: caller and recipient, in the order of the array, up to a turn id."""
    seen = dialogue if upto is None else F.filter(dialogue, lambda t: t["turn_id"] <= upto)
    return F.transform(
        seen,
        lambda t: F.struct(
            t["turn_id"].alias("turn_id"),
            F.when(t["speaker"] == "attacker", "caller").otherwise("recipient").alias("speaker"),
            surface_text(F.coalesce(t["utterance"], F.lit("")), surface).alias("utterance"),
        ),
    )


def last_of(array: Column, n: int) -> Column:
    """The last ``n`` entries; all of a shorter array."""
    return F.slice(array, F.greatest(F.size(array) - n + 1, F.lit(1)), F.lit(n))


def policy_card() -> Column:
    return F.array(*[F.struct(F.lit(rule).alias("rule_id"), F.lit(text).alias("text")) for rule, text in K.POLICY_CARD])


def _by_event(event: Column, table: dict) -> Column:
    value = lambda v: F.lit(v) if isinstance(v, str) else F.array(*map(F.lit, v))
    return reduce(lambda out, pair: out.when(event == pair[0], value(pair[1])), table.items(), F)


def action_of(event: Column) -> Column:
    return _by_event(event, K.EVENT_ACTION)


def rules_of(event: Column) -> Column:
    return _by_event(event, K.EVENT_RULES)


def in_window(ids: Column, window: Column, fallback: Column) -> Column:
    """Evidence that the window shows; else the turn itself, if it is shown."""
    shown = F.transform(window, lambda t: t["turn_id"])
    kept = F.filter(ids, lambda k: F.array_contains(shown, k))
    return F.when(F.size(kept) > 0, kept).when(F.array_contains(shown, fallback), F.array(fallback)).otherwise(F.array().cast("array<int>"))


def sliding_windows(turns: DataFrame, *, stream: str, position: str, fields: tuple[str, ...], size: int = 6) -> DataFrame:
    """``window``: the last ``size`` turns of each stream, up to and with the row's own; for tables of turns (one exchange)."""
    w = W.partitionBy(stream).orderBy(position).rowsBetween(-(size - 1), 0)
    return turns.withColumn("window", F.collect_list(F.struct(position, *fields)).over(w))


#: The sets of earlier turns are kept as bits of a number, a bit for each name.
REQUESTS, PRESSURES = tuple(sorted(K.REQUEST_KEYWORDS)), tuple(sorted(K.PRESSURE_KEYWORDS))


def _bits(text: Column, lexicon: dict[str, tuple[str, ...]], names: tuple[str, ...]) -> Column:
    return reduce(lambda out, k: out + F.when(contains_any(text, lexicon[names[k]]), 1 << k).otherwise(0), range(len(names)), F.lit(0))


def unpacked(bits: Column, names: tuple[str, ...]) -> Column:
    """The names of the bits that are set, in order."""
    return F.filter(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, name) for k, name in enumerate(names)]), lambda x: x.isNotNull())


def signs(turns: DataFrame) -> DataFrame:
    """Adds what one turn's words say: ``_requests`` and ``_pressures`` as bits, ``_disclosure``, ``_defense``, ``_caller``, ``_path``."""
    caller, victim, text = F.col("speaker") == "attacker", F.col("speaker") == "victim", F.coalesce("utterance", F.lit(""))
    return turns.select(
        "*",
        F.when(caller, _bits(text, K.REQUEST_KEYWORDS, REQUESTS)).otherwise(0).alias("_requests"),
        F.when(caller, _bits(text, K.PRESSURE_KEYWORDS, PRESSURES)).otherwise(0).alias("_pressures"),
        F.when(victim, L.stream_disclosure_state(text)).otherwise("none").alias("_disclosure"),
        F.when(victim, L.defense_action(text)).otherwise("none").alias("_defense"),
        F.coalesce(caller, F.lit(False)).alias("_caller"),
        L.names_path(text).alias("_path"),
    )


def decided(rows: DataFrame, position: str = "turn_id") -> DataFrame:
    """Adds ``event``, ``action``, ``policy_rule_ids`` and ``evidence_turn_ids`` to signs with ``_before_requests``, ``_before_pressures`` and ``_last``, the last earlier disclosure."""
    requests, pressures, earlier, pressed = (F.col(c) for c in ("_requests", "_pressures", "_before_requests", "_before_pressures"))
    has = lambda bits: bits != 0
    new = lambda bits, before: bits.bitwiseAND(F.bitwise_not(before)) != 0
    names_path = F.lit(1 << REQUESTS.index(K.PATH_REQUEST))
    before_path, path = has(earlier.bitwiseAND(names_path)), has(requests.bitwiseAND(names_path)) | F.col("_path")
    event = (
        F.when(F.col("_disclosure") == DIRECT, "recipient_partial_or_direct_disclosure")
        .when(F.col("_last").isNotNull(), "recovery_followup_due")
        .when(F.col("_caller") & path & ~before_path, "new_caller_directed_path")
        .when(F.col("_caller") & new(requests, earlier), "new_sensitive_request")
        .when(F.col("_caller") & new(pressures, pressed) & (has(earlier) | has(requests)), "pressure_escalation")
        .when(F.col("_defense") == "safe_verify_or_refuse", "recipient_containment")
        .when(F.col("_caller") & has(pressures) & ~has(requests) & ~has(earlier), "pressure_only_monitor")
        .when(~has(earlier) & ~has(requests) & ~has(pressed) & ~has(pressures), "needs_more_context")
        .otherwise("no_new_actionable_event")
    )
    out = rows.withColumn("event", event)
    evidence = F.array(F.when(F.col("event") == "recovery_followup_due", F.col("_last")).otherwise(F.col(position)))
    return out.withColumn("action", action_of(F.col("event"))).withColumn("policy_rule_ids", rules_of(F.col("event"))).withColumn("evidence_turn_ids", evidence)


def transitions(turns: DataFrame, *, stream: str = "stream_id", position: str = "turn_id", state: bool = True) -> DataFrame:
    """Adds ``event`` and what it rests on to a table of turns with ``speaker`` and ``utterance``.

    Everything that came before is a set of what earlier turn ids did: bits that
    are or-ed along one partitioning by stream, ordered by turn id, so a turn
    costs the same wherever it stands. ``state`` adds ``oracle_state``, which lists all
    earlier disclosures, and so grows along a stream that has many.
    """
    before = W.partitionBy(stream).orderBy(position).rangeBetween(W.unboundedPreceding, -1)
    disclosed = F.when(F.col("_disclosure") == DIRECT, F.col(position))
    earlier = {f"_before{c}": F.coalesce(F.bit_or(c).over(before), F.lit(0)) for c in ("_requests", "_pressures")} | {"_last": F.max(disclosed).over(before)}
    if state:
        earlier["_disclosures"] = F.sort_array(F.collect_list(disclosed).over(before))
    out = decided(signs(turns).withColumns(earlier), position)
    kept = [*turns.columns, "event", "action", "policy_rule_ids", "evidence_turn_ids"]
    if not state:
        return out.select(*kept)
    found = F.struct(
        unpacked(F.col("_before_requests"), REQUESTS).alias("prior_request_types"), unpacked(F.col("_requests"), REQUESTS).alias("current_request_types"), unpacked(F.col("_before_pressures"), PRESSURES).alias("prior_pressure_categories"),
        unpacked(F.col("_pressures"), PRESSURES).alias("current_pressure_categories"), F.col("_disclosure").alias("current_disclosure_state"), F.col("_defense").alias("current_recipient_defense_action"),
        F.col("_disclosures").alias("prior_direct_disclosure_turn_ids"),
    )
    return out.select(*kept, found.alias("oracle_state"))


def risky_placeholders(window: Column, buckets: dict[str, str]) -> Column:
    """Non-standard placeholders of a window whose bucket (none: reject) keeps an item from use."""
    found = F.array_distinct(F.flatten(F.transform(window, lambda t: placeholders(t["utterance"]))))
    safe = [*K.STANDARD_PLACEHOLDERS, *(p for p, b in buckets.items() if b not in ("reviewed_sensitive", "reject_or_escalate"))]
    return F.array_sort(F.filter(found, lambda p: ~p.isin(*safe)))


def private_summary() -> Column:
    meta = F.col("gen_metadata")
    return F.struct(
        F.col("id").alias("source_id"), "scenario_type", "outcome", "split", F.col("victim_persona.id").alias("victim_persona_id"), F.col("attacker_persona.id").alias("attacker_persona_id"),
        meta["target_outcome_mode"].alias("target_outcome_mode"), meta["pressure_style"].alias("pressure_style"), meta["environmental_context"].alias("environmental_context"),
        meta["prompt_version"].alias("prompt_version"), F.array(meta["attacker_model"], meta["victim_model"]).alias("model_pair"),
    )


def _rejected(rows: DataFrame, family: str, reason: str, detail: Column | None = None) -> DataFrame:
    return rows.select(F.lit(family).alias("family"), F.coalesce("id", F.lit("unknown")).alias("source_id"), F.lit(reason).alias("reason"), (detail if detail is not None else F.lit("")).alias("detail"))


def _unrolled(records: DataFrame, family: str, surface: str, size: int, stream_id: Column, buckets: dict[str, str]) -> DataFrame:
    """A row a turn, with its public window; the window comes from the record's own array, so nothing is shuffled."""
    rows = records.select("*", F.explode("dialogue").alias("turn")).withColumn("turn_id", F.coalesce(F.col("turn.turn_id"), F.lit(0)))
    rows = rows.withColumn("window", last_of(public_turns(F.col("dialogue"), surface, F.col("turn_id")), size))
    return rows.select(
        "*", F.lit(family).alias("family"), F.lit(surface).alias("surface"), stream_id.alias("stream_id"),
        stable_id("ssi", family, F.coalesce("id", F.lit("unknown")), F.col("turn_id"), surface).alias("benchmark_id"),
        F.when(F.size(risky_placeholders(F.col("window"), buckets)) > 0, "diagnostic_only").otherwise("programmatic_validated").alias("placeholder_status"),
    )


def _items(rows: DataFrame, gold: list, manifest: list) -> tuple[DataFrame, DataFrame, DataFrame]:
    public = rows.select(
        "benchmark_id", "stream_id", "family", F.lit("stream_rollout").alias("mode"), F.lit(K.ITEM_VERSION).alias("schema_version"), F.coalesce("locale", F.lit("ko-KR")).alias("locale"), "surface",
        F.col("turn_id").alias("stream_position"), F.struct(F.col("window").alias("dialogue_window"), policy_card().alias("policy_card")).alias("input"),
    )
    speaker = F.element_at("window", -1)["speaker"]
    private = rows.select(
        "benchmark_id", "stream_id", "family", F.lit(K.ITEM_VERSION).alias("schema_version"), private_summary().alias("source"), "surface", F.col("turn_id").alias("stream_position"),
        F.col("turn_id").alias("current_turn_id"), speaker.alias("current_speaker"), "split_group_id", "gold_status", "placeholder_status", *manifest,
    )
    return public, private, rows.select("benchmark_id", "stream_id", "family", "gold_status", "event", "action", "policy_rule_ids", "evidence_turn_ids", *gold)


def build_observed_items(records: DataFrame, buckets: dict[str, str], *, family: str = K.DIAGNOSTIC_FAMILY, surface: str = "typed_raw", size: int = 6, drop_risky: bool = True) -> dict[str, DataFrame]:
    """Items whose gold comes from what the turns do: ``public``, ``manifest``, ``gold`` and ``rejected``."""
    source = F.coalesce("id", F.lit("unknown"))
    marked = records.withColumn("_bracket", has_bracket(F.col("dialogue"))).withColumn("_empty", F.coalesce(F.size("dialogue"), F.lit(0)) <= 0)
    usable = marked.where("NOT coalesce(_bracket, false) AND NOT _empty").drop("_bracket", "_empty")
    rows = _unrolled(usable, family, surface, size, stable_id("stream", family, source, surface), buckets)
    risky = (F.col("placeholder_status") == "diagnostic_only") if drop_risky else F.lit(False)
    told = transitions(usable.select(source.alias("_source"), F.explode("dialogue").alias("_t")).select("_source", "_t.turn_id", "_t.speaker", "_t.utterance"), stream="_source")
    told = told.drop("speaker", "utterance").dropDuplicates(["_source", "turn_id"])
    rows = rows.where(~risky).withColumn("_source", source).join(told, ["_source", "turn_id"])
    status = F.lit("diagnostic_only") if family == K.DIAGNOSTIC_FAMILY else F.col("placeholder_status")
    stance = "diagnostic_only" if family == K.DIAGNOSTIC_FAMILY else "official_candidate_pending_gates"
    rows = rows.withColumn("evidence_turn_ids", in_window(F.col("evidence_turn_ids"), F.col("window"), F.col("turn_id"))).withColumn("gold_status", status).withColumn("split_group_id", stable_id("stream_group", source))
    public, manifest, gold = _items(rows, ["oracle_state"], [F.lit(stance).alias("release_stance")])
    rejected = _rejected(marked.where("_bracket"), family, "stage_direction_or_unmasked_bracket").unionByName(_rejected(marked.where("NOT coalesce(_bracket, false) AND _empty"), family, "no_dialogue_turns"))
    if drop_risky:
        rejected = rejected.unionByName(_rejected(_unrolled(usable, family, surface, size, F.lit(""), buckets).where(risky), family, "placeholder_reject_or_escalate", F.col("turn_id").cast("string")))
    return {"public": public, "manifest": manifest, "gold": gold, "rejected": rejected}


def build_planned_items(records: DataFrame, buckets: dict[str, str], *, family: str = K.CANDIDATE_FAMILY, surface: str = "typed_raw", size: int = 6) -> dict[str, DataFrame]:
    """Items whose gold is the plan that each turn carries; turns without a plan are rejected."""
    source = F.coalesce("id", F.lit("unknown"))
    marked = records.withColumn("_bracket", F.coalesce(has_bracket(F.col("dialogue")), F.lit(False)))
    rows = _unrolled(marked.where("NOT _bracket").drop("_bracket"), family, surface, size, stable_id("streamv2", source, surface), buckets)
    planned = F.coalesce(F.col("turn.stream_event"), F.lit("")) != ""
    meta, turn = F.col("gen_metadata"), F.col("turn")
    good = rows.where(planned).select(
        "*", turn["stream_event"].alias("event"), turn["stream_action"].alias("action"), turn["stream_policy_rule_ids"].alias("policy_rule_ids"),
        in_window(F.coalesce(turn["stream_evidence_turn_ids"], F.array("turn_id")), F.col("window"), F.col("turn_id")).alias("evidence_turn_ids"),
        F.when(F.col("placeholder_status") == "programmatic_validated", "programmatic_validated").otherwise("diagnostic_only").alias("gold_status"),
        stable_id("streamv2_group", source).alias("split_group_id"), F.coalesce(F.array_contains(meta["fallback_turn_ids"], F.col("turn_id")), F.lit(False)).alias("is_fallback_turn"),
    )
    extra = [meta["stream_profile"].alias("stream_profile"), meta["trajectory_variant"].alias("trajectory_variant"), meta["canonical_pair_index"].alias("canonical_pair_index"), "is_fallback_turn", F.lit("official_candidate_pending_gates").alias("release_stance")]
    public, manifest, gold = _items(good, ["is_fallback_turn"], extra)
    rejected = _rejected(marked.where("_bracket"), family, "stage_direction_or_unmasked_bracket").unionByName(_rejected(rows.where(~planned), family, "missing_stream_turn_target", F.col("turn_id").cast("string")))
    return {"public": public, "manifest": manifest, "gold": gold, "rejected": rejected}


def forbidden_keys(df: DataFrame) -> list[str]:
    """Names anywhere in a table's schema that a public item must not have; rows need not be read."""
    from pyspark.sql import types as T

    found: set[str] = set()

    def walk(kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                found.update({f.name} & set(K.FORBIDDEN_PUBLIC_KEYS))
                walk(f.dataType)
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType)
        elif isinstance(kind, T.MapType):
            walk(kind.valueType)

    walk(df.schema)
    return sorted(found)


def dense_counts(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """``column, n``: a row for every allowed value, 0 where none occurs."""
    spark = rows.sparkSession
    allowed = spark.createDataFrame([(v,) for v in values], f"{column} string")
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    return allowed.join(counted, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def yield_counts(items: dict[str, DataFrame]) -> DataFrame:
    """``metric, key, n``: the yield report in long form; events and actions with their zeros."""
    gold, public, manifest, rejected = (items[k] for k in ("gold", "public", "manifest", "rejected"))
    one = lambda df, metric, value: df.agg(value.alias("n")).select(F.lit(metric).alias("metric"), F.lit("").alias("key"), "n")
    by = lambda df, metric, column: df.groupBy(column).agg(F.count("*").alias("n")).select(F.lit(metric).alias("metric"), F.col(column).alias("key"), "n")
    dense = lambda metric, column, values: dense_counts(gold, column, values).select(F.lit(metric).alias("metric"), F.col(column).alias("key"), "n")
    parts = [
        one(public, "public_item_count", F.count("*")), one(public, "stream_count", F.count_distinct("stream_id")), dense("event_distribution", "event", K.EVENTS), dense("action_distribution", "action", K.ACTIONS),
        by(gold, "gold_status_distribution", "gold_status"), by(public, "surface_distribution", "surface"), by(manifest, "placeholder_status_distribution", "placeholder_status"),
        one(rejected, "rejected_count", F.count("*")), by(rejected, "rejected_by_reason", "reason"),
    ]
    return reduce(DataFrame.unionByName, parts)
