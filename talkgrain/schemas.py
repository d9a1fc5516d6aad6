"""Spark types of records, items and predictions, as DDL that readers take."""

from __future__ import annotations

from talkgrain.constants import CONTEXT_FIELDS

MASK = "STRUCT<label: STRING, placeholder: STRING>"
TURN = f"STRUCT<turn_id: INT, speaker: STRING, phase: STRING, utterance: STRING, intent_label: STRING, risk_signal: STRING, masked_items: ARRAY<{MASK}>, stream_event: STRING, stream_action: STRING, stream_policy_rule_ids: ARRAY<STRING>, stream_evidence_turn_ids: ARRAY<INT>>"
PERSONA = "STRUCT<id: STRING, name: STRING, description: STRING>"
CONTEXT = "STRUCT<" + ", ".join(f"{f}: STRING" for f in CONTEXT_FIELDS) + ">"

VICTIM = ("id STRING, name STRING, description STRING, vulnerabilities ARRAY<STRING>, resistance_style STRING, protected_assets ARRAY<STRING>")
ATTACKER = ("id STRING, name STRING, description STRING, default_goals ARRAY<STRING>, pressure_methods ARRAY<STRING>")
RECORD = (
    f"id STRING, dataset_name STRING, label STRING, scenario_type STRING, victim_persona {PERSONA}, attacker_persona {PERSONA}, protected_assets ARRAY<STRING>, attacker_goal STRING, outcome STRING, "
    "compromised_assets ARRAY<STRING>, difficulty STRUCT<attacker_sophistication: STRING, victim_susceptibility: STRING>, channel STRING, locale STRING, split STRING, context STRING, "
    f"dialogue ARRAY<{TURN}>, risk_labels ARRAY<STRING>, safety_masks ARRAY<{MASK}>, "
    f"gen_metadata STRUCT<attacker_model: STRING, victim_model: STRING, prompt_version: STRING, sampling: STRUCT<temperature: DOUBLE, max_tokens: INT>, environmental_context: {CONTEXT}, schedule_mode: STRING, "
    "canonical_pair_index: INT, variant_index: INT, target_outcome_mode: STRING, target_outcome_generation_attempts: INT, target_outcome_llm_rewrite_attempts: INT, target_outcome_llm_rewrite_applied: BOOLEAN, "
    "target_outcome_deterministic_repair_applied: BOOLEAN, target_outcome_repair_applied: BOOLEAN, pressure_style: STRING, environmental_context_variant_id: STRING, generator: STRING, stream_profile: STRING, "
    "stream_mode: STRING, trajectory_variant: STRING, fallback_turn_ids: ARRAY<INT>, semantic_repair_turn_ids: ARRAY<INT>, seed: INT, timestamp: STRING>, "
    "quality_checks STRUCT<turn_count: INT, role_order_valid: BOOLEAN, safety_passed: BOOLEAN, no_duplicate_turns: BOOLEAN, label_consistent: BOOLEAN, language_consistent: BOOLEAN, no_refusal_leak: BOOLEAN, "
    "residual_pii_clean: BOOLEAN, schema_valid: BOOLEAN, stream_semantic_valid: BOOLEAN, partial_disclosure_semantic_valid: BOOLEAN, speaker_perspective_valid: BOOLEAN, duplicate_turns_clean: BOOLEAN, benign_thin_context_valid: BOOLEAN>"
)
WINDOW_TURN = "STRUCT<turn_id: INT, speaker: STRING, utterance: STRING>"
PREDICTION = ("benchmark_id STRING, event STRING, action STRING, policy_rule_ids ARRAY<STRING>, evidence_turn_ids ARRAY<INT>, confidence DOUBLE")
