"""Which personas meet in which scenario: columns over a range of indexes, joined with small catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions.ids import record_id


def _cycle(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def phase_for_turn(turn_id: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, K.PHASES)), (F.least(F.floor((turn_id - 1) / 2), F.lit(4)) + 1).cast("int"))


def planned_phase(turn_id: Column) -> Column:
    """The planner's layout of eight turns: resistance at six and seven, the close at eight."""
    return F.when(turn_id == 6, "handle_resistance").when(turn_id == 8, "close").otherwise(phase_for_turn(turn_id))


def split_for_index(index: Column) -> Column:
    place = F.pmod(index, F.lit(10))
    return F.when(place < 8, "train").when(place == 8, "val").otherwise("test")


def difficulty_for_index(index: Column) -> Column:
    return F.struct(_cycle(index, K.DIFFICULTIES).alias("attacker_sophistication"), _cycle(F.floor(index / 3), K.DIFFICULTIES).alias("victim_susceptibility"))


def target_outcome(index: Column, mode: str) -> Column:
    if mode == "canonical_repeat":
        return _cycle(index, K.TARGET_OUTCOME_MODES)
    return F.when(difficulty_for_index(index)["victim_susceptibility"] == "high", "inconclusive").otherwise("defended_success")


def pressure_style(index: Column) -> Column:
    return _cycle(index, K.PRESSURE_STYLES)


def profile_for_index(index: Column) -> Column:
    return _cycle(index, K.PROFILES)


def trajectory_variant(index: Column, varied: bool) -> Column:
    return F.pmod(F.floor(index / 5), F.lit(6)).cast("string") if varied else F.lit("canonical")


def response_mode(target: Column, susceptibility: Column) -> Column:
    by_difficulty = F.when(susceptibility == "high", "partial_disclosure").when(susceptibility == "med", "uncertain").otherwise("defensive")
    return F.when(target == "masked_compromise", "partial_disclosure").when(target == "inconclusive", "uncertain").when(target == "defended_success", "defensive").otherwise(by_difficulty)


def outcome_matches(outcome: Column, target: Column) -> Column:
    return outcome == F.when(target == "masked_compromise", "compromised").otherwise(target)


def generation_attempts(target: Column) -> Column:
    return F.when(target.isin(*K.TARGET_OUTCOME_MODES), 3).otherwise(1)


def attempt_limit(target: int, skipped: int, victims: int, attackers: int) -> int:
    """How many indexes a run may look at to reach its target."""
    return max(4 * (target + skipped), victims * attackers, target)


def attacker_goal(goals: Column, assets: Column) -> Column:
    """The first of an attacker's goals; without any, what the assets suggest."""
    some = lambda *words: F.exists(assets, lambda a: F.greatest(*[a.contains(w) for w in words]) if len(words) > 1 else a.contains(words[0]))
    guess = F.when(some("otp", "credential", "password"), "credential_capture").when(some("account", "payment"), "money_transfer").otherwise("identity_information")
    return F.coalesce(F.get(goals, 0), guess)


def primary_risk(scenario: Column, goal: Column) -> Column:
    by_goal = F.when(goal == "money_transfer", "money_transfer_request").when(goal == "credential_capture", "credential_request").when(goal == "voice_sample_or_callback", "callback_or_voice_sample_request")
    return by_goal.when(scenario == "family_emergency", "emotional_pressure").otherwise("identity_information_request")


def overlay(base: Column, variant: Column) -> Column:
    """A scenario's context with a variant's fields over it."""
    return F.struct(*[F.coalesce(variant[f], base[f]).alias(f) for f in K.CONTEXT_FIELDS])


def compact_persona(persona: Column) -> Column:
    return F.struct(persona["id"].alias("id"), F.coalesce(persona["name"], persona["id"]).alias("name"), F.coalesce(persona["description"], F.lit("")).alias("description"))


def _placed(catalog: DataFrame, prefix: str) -> DataFrame:
    return catalog.select(F.col("pos").alias(f"_{prefix}_pos"), F.col("id").alias(f"{prefix}_id"))


def schedule(
    spark: SparkSession, victims: DataFrame, attackers: DataFrame, scenarios: DataFrame, *, start: int = 0, count: int, mode: str = "rotating", dataset: str = "dataset",
    pair_scenarios: DataFrame | None = None, attacker_scenarios: DataFrame | None = None, victim_scenarios: DataFrame | None = None, pair_only: tuple[str, ...] = (),
) -> DataFrame:
    """One row an index: the pair, its scenario, and all that follows from the index.

    Catalogs: ``pos`` (from 0) and ``id``; ``scenarios``: ``pos, scenario``.
    Preferences: ``victim_id, attacker_id, preferred`` and ``id, preferred``. A
    preference counts if it is configured; those of one persona don't give
    scenarios that are for pairs only. Without one, the scenario at the index
    counts, or the next one that is not for pairs only.
    """
    n_victims, n_attackers, n_scenarios = victims.count(), attackers.count(), scenarios.count()
    if not (n_victims and n_attackers and n_scenarios):
        raise ValueError("catalogs must have at least one persona each, and one scenario")
    i = F.col("index")
    rows = spark.range(start, start + count).withColumnRenamed("id", "index")
    if mode == "canonical_repeat":
        pairs = min(n_victims, n_attackers)
        rows = rows.select("index", F.pmod(i, F.lit(pairs)).alias("_victim_pos"), F.pmod(i, F.lit(pairs)).alias("_attacker_pos"), F.pmod(i, F.lit(pairs)).cast("int").alias("canonical_pair_index"), F.floor(i / pairs).cast("int").alias("variant_index"))
    elif mode == "rotating":
        rows = rows.select("index", F.pmod(i, F.lit(n_victims)).alias("_victim_pos"), F.pmod(F.floor(i / n_victims) + i, F.lit(n_attackers)).alias("_attacker_pos"), F.lit(None).cast("int").alias("canonical_pair_index"), F.lit(0).alias("variant_index"))
    else:
        raise ValueError("mode is canonical_repeat or rotating")
    rows = rows.join(F.broadcast(_placed(victims, "victim")), "_victim_pos").join(F.broadcast(_placed(attackers, "attacker")), "_attacker_pos")
    configured = scenarios.select("scenario")
    usable = lambda prefs, keys, name, alone: (
        F.broadcast(prefs.join(configured, prefs.preferred == configured.scenario).where(~F.col("preferred").isin(*pair_only) if alone and pair_only else F.lit(True)).select(*keys, F.col("preferred").alias(name)))
    )
    choices = []
    if pair_scenarios is not None:
        rows = rows.join(usable(pair_scenarios, ["victim_id", "attacker_id"], "_by_pair", False), ["victim_id", "attacker_id"], "left")
        choices.append("_by_pair")
    for prefs, key, name in ((attacker_scenarios, "attacker_id", "_by_attacker"), (victim_scenarios, "victim_id", "_by_victim")):
        if prefs is not None:
            rows = rows.join(usable(prefs.withColumnRenamed("id", key), [key], name, True), key, "left")
            choices.append(name)
    names = [r.scenario for r in scenarios.orderBy("pos").collect()]  # a configuration's list
    fallback = []
    for k in range(n_scenarios):
        rotated = names[k:] + names[:k]
        fallback.append(next((s for s in rotated if s not in pair_only), names[k]))
    scenario = F.coalesce(*[F.col(c) for c in choices], _cycle(i, tuple(fallback)))
    return rows.select(
        "index", "victim_id", "attacker_id", scenario.alias("scenario_type"), F.lit(mode).alias("schedule_mode"), "canonical_pair_index", "variant_index", target_outcome(i, mode).alias("target_outcome_mode"),
        pressure_style(i).alias("pressure_style"), F.format_string("variant_%02d", F.pmod(F.col("variant_index"), F.lit(4))).alias("environmental_context_variant_id"), split_for_index(i).alias("split"), difficulty_for_index(i).alias("difficulty"),
        record_id(F.lit(dataset), F.col("victim_id"), F.col("attacker_id"), scenario, i).alias("record_id"),
    )


def not_yet_written(scheduled: DataFrame, existing_ids: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` scheduled rows whose record is not there yet: what an append or a resumed run still has to do."""
    return scheduled.join(existing_ids.select(F.col("id").alias("record_id")), "record_id", "left_anti").orderBy("index").limit(limit)


#: What a scenario's callers are after, where a persona pair says nothing else (fixed values).
SCENARIO_ASSETS = {
    "family_emergency": ("bank_account_access", "otp_or_security_card", "family_relationship_details"),
    "bank_fraud_alert": ("account_password", "otp_or_security_card", "identity_document_image"),
    "workplace_authority": ("company_payment_authority", "internal_credentials", "vendor_account_details"),
    "essential_service_notice": ("utility_account_credentials", "billing_or_autopay_details", "service_address_details"),
    "document_verification_notice": ("identity_document_image", "case_reference_number", "language_support_portal_credentials"),
    "public_benefit_notice": ("benefit_portal_credentials", "identity_document_image", "bank_account_for_disbursement", "case_reference_number"),
    "platform_policy_notice": ("creator_platform_credentials", "payout_account_details", "tax_or_identity_documents"),
    "education_admin_notice": ("guardian_identity_details", "student_or_dependent_records", "school_portal_credentials", "activity_payment_details"),
    "tax_refund_notice": ("tax_portal_access_status", "taxpayer_identity_reference", "case_reference_number", "refund_status_details", "voice_sample"),
    "travel_booking_notice": ("travel_account_credentials", "booking_reference_number", "itinerary_contact_details", "booking_payment_status_reference", "voice_sample"),
    "property_claim_notice": ("claim_reference_number", "property_policy_account", "policyholder_identity_reference", "incident_contact_details", "voice_sample"),
    "emergency_drill_notice": ("preparedness_notice_reference", "drill_callback_reference", "registered_contact_details", "callback_window_preference", "voice_sample"),
    "nonprofit_admin_notice": ("event_callback_reference", "volunteer_role_details", "coordinator_contact_details", "voice_sample"),
    "pet_appointment_notice": ("appointment_reference_number", "pet_profile_reference", "registered_contact_details", "clinic_callback_reference", "voice_sample"),
    "research_study_notice": ("study_reference_number", "participant_contact_details", "participant_identity_reference", "study_portal_inbox_reference", "voice_sample"),
    "library_account_notice": ("library_account_reference", "digital_library_access_status", "hold_pickup_details", "registered_contact_details", "voice_sample"),
    "vehicle_service_notice": ("vehicle_account_reference", "service_appointment_details", "registered_contact_details", "recall_notice_reference", "voice_sample"),
    "ticketing_refund_notice": ("ticketing_account_access_status", "order_reference_number", "registered_contact_details", "event_account_inbox", "voice_sample"),
    "membership_access_notice": ("membership_reference_number", "member_contact_details", "entry_reservation_status", "mailed_notice_reference", "voice_sample"),
    "childcare_service_notice": ("guardian_identity_reference", "waitlist_reference_number", "registered_contact_details", "intake_appointment_details", "voice_sample"),
}
OTHER_ASSETS = ("identity_information", "voice_sample")
#: What a record's context says, where neither its pair nor its scenario has one (fixed value).
OTHER_CONTEXT = "딥보이스 사칭 기반 사회공학 대화 상황."


def default_assets(scenario: Column) -> Column:
    out = F
    for name, assets in SCENARIO_ASSETS.items():
        out = out.when(scenario == name, F.array(*map(F.lit, assets)))
    return out.otherwise(F.array(*map(F.lit, OTHER_ASSETS)))


def with_context(rows: DataFrame, pair_contexts: DataFrame, scenario_contexts: DataFrame) -> DataFrame:
    """Adds ``context``: of the persona pair, else of the scenario. Catalogs: ``victim_id, attacker_id, context`` and ``scenario_type, context``."""
    found = rows.join(pair_contexts.withColumnRenamed("context", "_pair"), ["victim_id", "attacker_id"], "left").join(scenario_contexts.withColumnRenamed("context", "_scenario"), "scenario_type", "left")
    return found.select(*rows.columns, F.coalesce(F.nullif("_pair", F.lit("")), "_scenario", F.lit(OTHER_CONTEXT)).alias("context"))
