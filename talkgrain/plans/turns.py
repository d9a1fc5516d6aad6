"""Planned turns: which event each of a dialogue's eight turns is to have, and the policy action it shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.operators.stream import action_of
from talkgrain.plans.schedule import planned_phase

#: Turns three to eight of each profile's six varied plans: event, what the turn shows (the goal's value, a link, a phone), the turn that is evidence. The first plan is also the canonical one (fixed values).
PLANS = {
    "safe_containment": (
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("recipient_containment", "goal", 6), ("no_new_actionable_event", "goal", 7), ("recipient_containment", "", 8)),
        (("new_sensitive_request", "goal", 3), ("recipient_containment", "goal", 4), ("pressure_escalation", "", 5), ("recipient_containment", "", 6), ("no_new_actionable_event", "", 7), ("no_new_actionable_event", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_caller_directed_path", "link", 5), ("recipient_containment", "", 6), ("new_sensitive_request", "goal", 7), ("recipient_containment", "goal", 8)),
        (("needs_more_context", "", 3), ("no_new_actionable_event", "", 4), ("pressure_only_monitor", "", 5), ("no_new_actionable_event", "", 6), ("new_sensitive_request", "goal", 7), ("recipient_containment", "goal", 8)),
        (("new_sensitive_request", "goal", 3), ("no_new_actionable_event", "", 4), ("new_caller_directed_path", "link", 5), ("recipient_containment", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
    ),
    "caller_directed_path": (
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("new_caller_directed_path", "link", 7), ("recipient_containment", "", 8)),
        (("new_caller_directed_path", "link", 3), ("recipient_containment", "", 4), ("new_sensitive_request", "goal", 5), ("recipient_containment", "goal", 6), ("no_new_actionable_event", "", 7), ("no_new_actionable_event", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_caller_directed_path", "link", 5), ("recipient_containment", "", 6), ("new_sensitive_request", "goal", 7), ("recipient_containment", "goal", 8)),
        (("needs_more_context", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("new_caller_directed_path", "link", 7), ("recipient_containment", "", 8)),
        (("new_sensitive_request", "goal", 3), ("no_new_actionable_event", "", 4), ("pressure_escalation", "", 5), ("no_new_actionable_event", "", 6), ("new_caller_directed_path", "link", 7), ("recipient_containment", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("recipient_containment", "goal", 6), ("new_caller_directed_path", "link", 7), ("recipient_containment", "", 8)),
    ),
    "partial_disclosure_recovery": (
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "phone", 5), ("recipient_partial_or_direct_disclosure", "phone", 6), ("recovery_followup_due", "goal", 6), ("recovery_followup_due", "", 6)),
        (("new_sensitive_request", "phone", 3), ("recipient_partial_or_direct_disclosure", "phone", 4), ("recovery_followup_due", "goal", 4), ("recovery_followup_due", "", 4), ("recovery_followup_due", "goal", 4), ("recovery_followup_due", "", 4)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "phone", 5), ("recipient_partial_or_direct_disclosure", "phone", 6), ("recovery_followup_due", "goal", 6), ("recovery_followup_due", "", 6)),
        (("new_sensitive_request", "phone", 3), ("no_new_actionable_event", "", 4), ("pressure_escalation", "", 5), ("recipient_partial_or_direct_disclosure", "phone", 6), ("recovery_followup_due", "goal", 6), ("recovery_followup_due", "", 6)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "phone", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_partial_or_direct_disclosure", "phone", 8)),
        (("new_sensitive_request", "phone", 3), ("no_new_actionable_event", "", 4), ("new_caller_directed_path", "link", 5), ("recipient_partial_or_direct_disclosure", "phone", 6), ("recovery_followup_due", "goal", 6), ("recovery_followup_due", "", 6)),
    ),
    "pressure_escalation": (
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("new_sensitive_request", "goal", 3), ("no_new_actionable_event", "", 4), ("pressure_escalation", "", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("needs_more_context", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("recipient_containment", "goal", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("new_sensitive_request", "goal", 3), ("no_new_actionable_event", "", 4), ("new_caller_directed_path", "link", 5), ("no_new_actionable_event", "", 6), ("pressure_escalation", "", 7), ("recipient_containment", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("new_sensitive_request", "goal", 5), ("no_new_actionable_event", "", 6), ("no_new_actionable_event", "", 7), ("recipient_containment", "", 8)),
    ),
    "benign_thin_context": (
        (("needs_more_context", "", 3), ("needs_more_context", "", 4), ("pressure_only_monitor", "", 5), ("no_new_actionable_event", "", 6), ("no_new_actionable_event", "", 7), ("recipient_containment", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("needs_more_context", "", 5), ("needs_more_context", "", 6), ("no_new_actionable_event", "", 7), ("no_new_actionable_event", "", 8)),
        (("needs_more_context", "", 3), ("no_new_actionable_event", "", 4), ("needs_more_context", "", 5), ("no_new_actionable_event", "", 6), ("pressure_only_monitor", "", 7), ("no_new_actionable_event", "", 8)),
        (("pressure_only_monitor", "", 3), ("no_new_actionable_event", "", 4), ("pressure_only_monitor", "", 5), ("no_new_actionable_event", "", 6), ("no_new_actionable_event", "", 7), ("recipient_containment", "", 8)),
        (("no_new_actionable_event", "", 3), ("no_new_actionable_event", "", 4), ("pressure_only_monitor", "", 5), ("no_new_actionable_event", "", 6), ("pressure_only_monitor", "", 7), ("no_new_actionable_event", "", 8)),
        (("needs_more_context", "", 3), ("needs_more_context", "", 4), ("no_new_actionable_event", "", 5), ("no_new_actionable_event", "", 6), ("pressure_only_monitor", "", 7), ("recipient_containment", "", 8)),
    ),
}
#: Every plan's first two turns (fixed values).
OPENING = (("needs_more_context", "", 1), ("needs_more_context", "", 2))
#: Recipients' turns without a new event that name an official way or refuse: profile, variant, turn (fixed values).
GUARDED = (("caller_directed_path", 3, 6), ("caller_directed_path", 4, 6), ("partial_disclosure_recovery", 4, 6), ("pressure_escalation", 5, 6))
#: What a goal asks for, and the risk of asking (fixed values).
GOAL_PLACEHOLDERS = {"credential_capture": "[MASKED_CREDENTIAL]", "money_transfer": "[MASKED_ACCOUNT]", "voice_sample_or_callback": "[MASKED_PHONE]"}
GOAL_RISKS = {"credential_capture": "credential_request", "money_transfer": "money_transfer_request", "voice_sample_or_callback": "callback_or_voice_sample_request"}
OTHER_PLACEHOLDER, OTHER_RISK = "[MASKED_PHONE]", "identity_information_request"
#: Parts of protected assets' names that say what is asked for, whatever the goal (fixed values).
CREDENTIAL_ASSETS, ACCOUNT_ASSETS = ("credential", "password"), ("bank", "payment", "account")
#: Intent and risk of a recipient's turn by event; other events leave the recipient unsure (fixed values).
RECIPIENT = {
    "recipient_containment": ("resist_or_verify_request", "victim_resistance"),
    "recovery_followup_due": ("resist_or_verify_request", "victim_resistance"),
    "recipient_partial_or_direct_disclosure": ("disclose_or_comply", "asset_disclosure"),
}


def layout_table(spark: SparkSession) -> DataFrame:
    """``profile, variant, turn_id, speaker, event, slot, guarded, evidence_turn_id``: the plans as rows, 280 in all."""
    rows = []
    for profile, plans in PLANS.items():
        for variant, plan in [*enumerate(plans), ("canonical", plans[0])]:
            for turn, (event, slot, evidence) in enumerate((*OPENING, *plan), start=1):
                rows.append((profile, str(variant), turn, "attacker" if turn % 2 else "victim", event, slot or None, (profile, variant, turn) in GUARDED, evidence))
    return spark.createDataFrame(rows, "profile string, variant string, turn_id int, speaker string, event string, slot string, guarded boolean, evidence_turn_id int")


def _mentions(assets: Column, parts: tuple[str, ...]) -> Column:
    joined = F.lower(F.array_join(F.coalesce(assets, F.array().cast("array<string>")), " "))
    found = F.lit(False)
    for part in parts:
        found = found | joined.contains(part)
    return found


def placeholder_for_goal(goal: Column, assets: Column) -> Column:
    """The value that a record's caller asks for: by the goal, or by what the assets are."""
    return (
        F.when((goal == "credential_capture") | _mentions(assets, CREDENTIAL_ASSETS), GOAL_PLACEHOLDERS["credential_capture"])
        .when((goal == "money_transfer") | _mentions(assets, ACCOUNT_ASSETS), GOAL_PLACEHOLDERS["money_transfer"])
        .otherwise(OTHER_PLACEHOLDER)
    )


def risk_for_goal(goal: Column) -> Column:
    out = F
    for name, risk in GOAL_RISKS.items():
        out = out.when(goal == name, risk)
    return out.otherwise(OTHER_RISK)


def _caller(event: Column, slot: Column, goal: Column) -> Column:
    """Intent and risk of a caller's turn: who asks for the goal's value has the goal's risk."""
    said = lambda intent, risk: F.struct(F.lit(intent).alias("intent_label"), (F.lit(risk) if isinstance(risk, str) else risk).alias("risk_signal"))
    return (
        F.when(event == "pressure_escalation", said("escalate_urgency", "urgency"))
        .when(event == "pressure_only_monitor", said("social_engineering_probe", "urgency"))
        .when(slot == "goal", said("request_identity_information", risk_for_goal(goal)))
        .when(slot.isNotNull(), said("request_identity_information", OTHER_RISK))
        .otherwise(said("social_engineering_probe", "authority_impersonation"))
    )


def _recipient(event: Column) -> Column:
    out = F
    for name, (intent, risk) in RECIPIENT.items():
        out = out.when(event == name, F.struct(F.lit(intent).alias("intent_label"), F.lit(risk).alias("risk_signal")))
    return out.otherwise(F.struct(F.lit("uncertain_response").alias("intent_label"), F.lit("victim_uncertainty").alias("risk_signal")))


def visible_action(event: Column, speaker: Column, turn_id: Column, placeholder: Column, risk: Column, guarded: Column) -> Column:
    """The action a reader of the turn would take; told apart from the event by speaker, turn, risk and what is shown.

    ``guarded``: the turn names an official way or a refusal; what contains a
    request always does.
    """
    caller, shown = speaker == "attacker", placeholder.isNotNull()
    secret, phone = placeholder.isin("[MASKED_CREDENTIAL]", "[MASKED_ACCOUNT]"), placeholder == "[MASKED_PHONE]"
    link, pressure = F.coalesce(placeholder == "[MASKED_URL]", F.lit(False)), risk.isin("urgency", "money_transfer_request")
    rules = {
        "needs_more_context": F.when(caller, "no_alert").otherwise("monitor_only"),
        "no_new_actionable_event": F.when(caller, "no_alert").when((turn_id <= 4) | ~guarded, "monitor_only").otherwise("no_alert"),
        "pressure_only_monitor": F.when(pressure & (turn_id >= 5), "pause_or_verify").otherwise("monitor_only"),
        "new_sensitive_request": F.when(F.coalesce(secret, F.lit(False)) | (turn_id >= 5), "refuse_or_pause").otherwise("pause_or_verify"),
        "new_caller_directed_path": F.when(link & turn_id.isin(5, 8), "refuse_or_pause").otherwise("pause_or_verify"),
        "pressure_escalation": F.when(pressure & (turn_id >= 7), "pause_or_verify").otherwise("monitor_only"),
        "recipient_containment": F.when((turn_id >= 8) & ~shown, "no_alert").otherwise("monitor_only"),
        "recipient_partial_or_direct_disclosure": F.when((turn_id <= 4) & F.coalesce(phone, F.lit(False)), "pause_or_verify").otherwise("preserve_and_report"),
        "recovery_followup_due": F.when(caller, "refuse_or_pause").otherwise("preserve_and_report"),
    }
    out = F
    for name, rule in rules.items():
        out = out.when(event == name, rule)
    return out.otherwise(action_of(event))


def rules_for_action(action: Column) -> Column:
    out = F
    for name, rules in K.ACTION_RULES.items():
        out = out.when(action == name, F.array(*map(F.lit, rules)))
    return out


def planned_turns(assignments: DataFrame) -> DataFrame:
    """The turns of ``record_id, profile, variant, goal`` (and ``protected_assets``, if there): eight rows each.

    They have event, intent and risk, placeholder, action, rules and evidence.
    Canonical plans take each event's usual action, varied ones the visible one.
    The plans are a table of 280 rows, which is broadcast.
    """
    assets = F.col("protected_assets") if "protected_assets" in assignments.columns else F.lit(None).cast("array<string>")
    rows = assignments.join(F.broadcast(layout_table(assignments.sparkSession)), ["profile", "variant"])
    shown = F.when(F.col("slot") == "link", "[MASKED_URL]").when(F.col("slot") == "phone", "[MASKED_PHONE]").when(F.col("slot") == "goal", placeholder_for_goal(F.col("goal"), assets))
    said = F.when(F.col("speaker") == "attacker", _caller(F.col("event"), F.col("slot"), F.col("goal"))).otherwise(_recipient(F.col("event")))
    rows = rows.withColumn("placeholder", shown).withColumn("_said", said).select("*", "_said.*").drop("_said")
    visible = visible_action(*(F.col(c) for c in ("event", "speaker", "turn_id", "placeholder", "risk_signal", "guarded")))
    rows = rows.withColumn("action", F.when(F.col("variant") == "canonical", action_of(F.col("event"))).otherwise(visible))
    return rows.select("*", planned_phase(F.col("turn_id")).alias("phase"), rules_for_action(F.col("action")).alias("policy_rule_ids"), F.array("evidence_turn_id").alias("evidence_turn_ids"))


def expected_outcome(profile: Column, observed: Column) -> Column:
    return F.when(profile == "partial_disclosure_recovery", "compromised").when(profile.isin("benign_thin_context", "pressure_escalation"), "inconclusive").when(observed == "compromised", "defended_success").otherwise(observed)
