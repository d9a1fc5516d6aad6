"""Whether an utterance does what its plan says: error codes, the first that holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain.constants import RESIDUE_MARKERS
from talkgrain.functions.text import contains_any, has_unknown_bracket, placeholders, utterance_artifact, without_masks

# Words by which the rules go (fixed values).
DISCLOSURE_VERBS = ("전달하겠습니다", "제공하겠습니다", "말씀드리겠습니다", "입력하겠습니다", "공유하겠습니다", "알려드리겠습니다", "알려드릴게요")
REQUEST_VOICE = ("확인해 주시면", "확인해주시면", "확인 부탁", "부탁드립니다", "주시기 바랍니다", "제공해 주시면", "입력해 주시면", "제출해 주시면", "필요합니다", "요구드립니다", "조치 부탁")
PRESSURE = ("긴급", "즉시", "지금", "오늘", "마감", "지연", "보류", "취소", "제한", "손실", "차질", "불가능")
CONTAINMENT = ("제공하지", "입력하지", "사용하지", "접속하지", "진행하지", "공식", "저장된", "직접", "확인하겠습니다")
STRONG_RESPONSE = ("신고", "차단", "고발")
PATH_WORDS = ("링크", "접속", "경로", "포털", "주소", "열어", "들어가")
REQUEST_WORDS = ("확인", "말씀", "제공", "입력", "보내", "필요", "제출")
REFUSALS = ("제공하지", "입력하지", "사용하지", "접속하지")
RECOVERY_WORDS = ("중단", "보존", "신고", "공식", "확인", "기록")
NO_DISCLOSURE_WORDS = ("공식", "신고", "중단", "보존", "제공하지", "입력하지")
CONTINUATION_WORDS = ("추가", "이어", "확인", "같은 방식")


def discloses_directly(text: Column) -> Column:
    return text.contains("[MASKED_") & contains_any(text, DISCLOSURE_VERBS)


def valid_utterance(text: Column, required: Column) -> Column:
    """One line, no other brackets, exactly the required placeholders, no address or number, no residue."""
    plain = ~text.contains("\n") & ~has_unknown_bracket(text) & ~text.rlike(r"(?U)https?://|www\.|\b\d{2,3}-\d{3,4}-\d{4}\b")
    exact = F.array_sort(placeholders(text)) == F.array_sort(required)
    return F.coalesce((text != "") & plain & exact & ~contains_any(text, RESIDUE_MARKERS) & utterance_artifact(text).isNull(), F.lit(False))


def semantic_error(text: Column, planned: Column, event: Column, speaker: Column, profile: Column) -> Column:
    """The first broken rule of a turn, or null; ``planned``: the placeholders that its plan has."""
    found = placeholders(text)
    some = F.size(found) > 0
    caller, recipient = speaker == "attacker", speaker == "victim"
    has = lambda *words: contains_any(text, words)
    rules: dict[str, list[tuple[Column, str]]] = {
        "needs_more_context": [(some, "needs_more_context_must_not_use_sensitive_placeholder")],
        "pressure_only_monitor": [(some, "pressure_only_monitor_must_not_use_sensitive_placeholder"), (~has(*PRESSURE), "pressure_only_monitor_needs_pressure_signal")],
        "new_sensitive_request": [(~caller, "new_sensitive_request_must_be_attacker"), (~some, "new_sensitive_request_missing_placeholder"), (~has(*REQUEST_WORDS), "new_sensitive_request_missing_request_language")],
        "new_caller_directed_path": [
            (~caller, "new_caller_directed_path_must_be_attacker"), (~F.array_contains(found, "[MASKED_URL]"), "new_caller_directed_path_missing_masked_url"),
            (~contains_any(without_masks(text), PATH_WORDS), "new_caller_directed_path_missing_path_language"),
        ],
        "pressure_escalation": [(~caller, "pressure_escalation_must_be_attacker"), (some, "pressure_escalation_must_not_add_placeholder"), (~has(*PRESSURE), "pressure_escalation_missing_pressure_signal")],
        "recipient_containment": [
            (~recipient, "recipient_containment_must_be_victim"), (discloses_directly(text) & ~has(*REFUSALS), "recipient_containment_contains_direct_disclosure"),
            (~has(*CONTAINMENT), "recipient_containment_missing_safe_path_or_refusal"),
        ],
        "recipient_partial_or_direct_disclosure": [
            (~recipient, "recipient_disclosure_must_be_victim"), (~some, "recipient_disclosure_missing_placeholder"), (~discloses_directly(text), "recipient_disclosure_missing_first_person_disclosure_verb"),
            (has(*REQUEST_VOICE), "recipient_disclosure_uses_caller_request_voice"), (has(*NO_DISCLOSURE_WORDS), "recipient_disclosure_contains_recovery_or_refusal_language"),
        ],
        "recovery_followup_due": [
            (recipient & some, "victim_recovery_followup_must_not_add_placeholder"), (recipient & ~has(*RECOVERY_WORDS), "victim_recovery_followup_missing_recovery_language"),
            (caller & (F.size(planned) > 0) & ~has(*CONTINUATION_WORDS), "caller_recovery_followup_missing_continuation_language"),
        ],
    }
    benign = profile == "benign_thin_context"
    out = F.when(F.array_sort(found) != F.array_sort(planned), "semantic_placeholder_mismatch").when(utterance_artifact(text).isNotNull(), utterance_artifact(text))
    out = out.when(benign & some, "benign_thin_context_must_not_use_sensitive_placeholder").when(benign & has(*STRONG_RESPONSE), "benign_thin_context_uses_overstrong_response_language")
    for name, checks in rules.items():
        for broken, code in checks:
            out = out.when((event == name) & broken, code)
    return out.when(~event.isin(*rules) & recipient & discloses_directly(text), "victim_direct_disclosure_on_non_disclosure_event")


def stream_flags(dialogue: Column, profile: Column) -> Column:
    """Five booleans of a record whose turns carry ``stream_event``."""
    text = lambda t: F.coalesce(t["utterance"], F.lit(""))
    event = lambda t: F.coalesce(t["stream_event"], F.lit("no_new_actionable_event"))
    wrong = lambda t: semantic_error(text(t), placeholders(text(t)), event(t), t["speaker"], profile).isNotNull()
    disclosure = F.filter(dialogue, lambda t: event(t) == "recipient_partial_or_direct_disclosure")
    said = F.array_join(F.transform(dialogue, text), "\n")
    keys = F.transform(dialogue, lambda t: F.regexp_replace(F.lower(text(t)), r"(?U)\s+", ""))
    return F.struct(
        (~F.exists(dialogue, wrong)).alias("stream_semantic_valid"),
        ((profile != "partial_disclosure_recovery") | ((F.size(disclosure) > 0) & ~F.exists(disclosure, wrong))).alias("partial_disclosure_semantic_valid"),
        (~F.exists(disclosure, lambda t: (t["speaker"] == "victim") & contains_any(text(t), REQUEST_VOICE))).alias("speaker_perspective_valid"),
        (F.size(F.array_distinct(keys)) == F.size(dialogue)).alias("duplicate_turns_clean"),
        ((profile != "benign_thin_context") | ~contains_any(said, ("[MASKED_", *STRONG_RESPONSE))).alias("benign_thin_context_valid"),
    )
