"""The vocabulary that records, labels and reports share."""

from __future__ import annotations

# Enumerations.
LABELS = ("attack", "benign", "borderline")
OUTCOMES = ("defended_success", "compromised", "aborted", "inconclusive")
SPLITS = ("train", "val", "test")
PHASES = ("opening", "establish_context", "make_request", "handle_resistance", "close")
DIFFICULTIES = ("low", "med", "high")
SURFACES = ("typed_raw", "neutral_mask", "placeholder_ablated")
PROFILES = ("safe_containment", "caller_directed_path", "partial_disclosure_recovery", "pressure_escalation", "benign_thin_context")
TARGET_OUTCOME_MODES = ("defended_success", "inconclusive", "masked_compromise")
PRESSURE_STYLES = ("urgency", "authority", "consequence", "relationship_or_emotional_pressure", "process_control")
QUALITY_FLAGS = ("role_order_valid", "safety_passed", "no_duplicate_turns", "label_consistent", "language_consistent", "no_refusal_leak", "residual_pii_clean", "schema_valid")
CONTEXT_FIELDS = ("channel", "timing", "trigger_event", "claimed_authority", "victim_constraint", "verification_path")

RECORD_FIELDS = (
    "id", "dataset_name", "label", "scenario_type", "victim_persona", "attacker_persona", "protected_assets", "attacker_goal", "outcome", "compromised_assets",
    "difficulty", "channel", "locale", "split", "context", "dialogue", "risk_labels", "safety_masks", "gen_metadata", "quality_checks",
)
TURN_FIELDS = ("turn_id", "speaker", "phase", "utterance", "intent_label", "risk_signal", "masked_items")

# The stream benchmark.
DIAGNOSTIC_FAMILY = "selective_attack_stream_dedupe_recovery_diagnostic_v0"
CANDIDATE_FAMILY = "selective_stream_intervention_v1"
ITEM_VERSION = "stream_item_v1"
EVENTS = (
    "no_new_actionable_event", "needs_more_context", "pressure_only_monitor", "new_sensitive_request", "new_caller_directed_path",
    "pressure_escalation", "recipient_containment", "recipient_partial_or_direct_disclosure", "recovery_followup_due",
)
ACTIONS = ("no_alert", "monitor_only", "pause_or_verify", "refuse_or_pause", "preserve_and_report")
ACTIVE_ACTIONS = ("pause_or_verify", "refuse_or_pause", "preserve_and_report")
POLICY_CARD = (
    ("P_MONITOR", "Monitor when evidence is thin or no new event occurred."),
    ("P_NO_SECRET", "Do not share sensitive values through a caller-directed path."),
    ("P_VERIFY", "Pause and verify through an official or previously known channel."),
    ("P_REFUSE", "Refuse caller-directed sensitive requests."),
    ("P_RECOVER", "After disclosure, pause, preserve evidence, and report through official channels."),
)
EVENT_ACTION = {
    "no_new_actionable_event": "no_alert",
    "needs_more_context": "monitor_only",
    "pressure_only_monitor": "monitor_only",
    "new_sensitive_request": "refuse_or_pause",
    "new_caller_directed_path": "refuse_or_pause",
    "pressure_escalation": "pause_or_verify",
    "recipient_containment": "no_alert",
    "recipient_partial_or_direct_disclosure": "preserve_and_report",
    "recovery_followup_due": "preserve_and_report",
}
EVENT_RULES = {
    "no_new_actionable_event": ("P_MONITOR",),
    "needs_more_context": ("P_MONITOR",),
    "pressure_only_monitor": ("P_MONITOR",),
    "new_sensitive_request": ("P_NO_SECRET", "P_REFUSE"),
    "new_caller_directed_path": ("P_NO_SECRET", "P_REFUSE"),
    "pressure_escalation": ("P_VERIFY",),
    "recipient_containment": ("P_MONITOR",),
    "recipient_partial_or_direct_disclosure": ("P_RECOVER",),
    "recovery_followup_due": ("P_RECOVER",),
}
ACTION_RULES = {
    "no_alert": ("P_MONITOR",),
    "monitor_only": ("P_MONITOR",),
    "pause_or_verify": ("P_VERIFY",),
    "refuse_or_pause": ("P_NO_SECRET", "P_REFUSE"),
    "preserve_and_report": ("P_RECOVER",),
}
MISS_COST = {"new_sensitive_request": 3.0, "new_caller_directed_path": 3.0, "pressure_escalation": 3.0, "recipient_partial_or_direct_disclosure": 5.0, "recovery_followup_due": 5.0}
OTHER_MISS_COST = 2.0
FALSE_ACTIVE_COST, WRONG_ACTION_COST, DUPLICATE_ALERT_COST, INVALID_COST, BAD_EVIDENCE_COST = 2.0, 1.0, 1.0, 2.0, 1.0
LATE_COST_PER_TURN, LATE_COST_CAP = 0.5, 2.0
BASELINES = (
    "always_active", "never_active", "caller_turn_only", "position_only", "current_keyword", "prefix_keyword", "placeholder_count_or_type", "repeat_prior_state",
    "static_verify", "static_refuse", "static_preserve_on_any_mask", "window_length_only", "shuffled_dialogue",
)

# Masks, in the order in which their patterns apply.
MASKS = (
    ("url", "[MASKED_URL]", r"(?iU)https?://[^\s]+|www\.[^\s]+"),
    ("rrn", "[MASKED_RRN]", r"(?U)\b\d{6}-[1-4]\d{6}\b"),
    ("otp", "[MASKED_OTP]", r"(?iU)\b(?:otp|인증번호|보안코드|verification code)[:\s-]*\d{4,8}\b"),
    ("phone", "[MASKED_PHONE]", r"(?U)\b(?:010|011|016|017|018|019)-?\d{3,4}-?\d{4}\b"),
    ("email", "[MASKED_EMAIL]", r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"),
    ("account", "[MASKED_ACCOUNT]", r"(?U)\b(?!(?:19|20)\d{2}-\d{2}-\d{2}\b)\d{2,6}-\d{2,6}-\d{5,8}\b"),
    ("credential", "[MASKED_CREDENTIAL]", r"(?iU)\b(?:password|passwd|비밀번호|pin)[:\s-]*[A-Za-z0-9!@#$%^&*]{4,}\b"),
)
STANDARD_PLACEHOLDERS = tuple(sorted(placeholder for _, placeholder, _ in MASKS))
REVIEWED_PLACEHOLDERS = ("[MASKED_CASE_REFERENCE]", "[MASKED_COMPANY]", "[MASKED_ID_IMAGE]", "[MASKED_NAME]", "[MASKED_VOICE_SAMPLE]")
PLACEHOLDER = r"\[MASKED_[A-Z0-9_]+\]"
UNKNOWN_BRACKET = r"\[(?!MASKED_[A-Z0-9_]+\])[^\]]+\]"
STAGE_DIRECTION = r"\[(?!MASKED_)[^\]]{1,80}\]"
ALIASES = {
    "[MASKED_ACCOUNT_NUMBER]": "[MASKED_ACCOUNT]",
    "[MASKED_BANK_ACCOUNT]": "[MASKED_ACCOUNT]",
    "[MASKED_POLICY_ACCOUNT]": "[MASKED_ACCOUNT]",
    "[MASKED_PROPERTY_POLICY_ACCOUNT]": "[MASKED_ACCOUNT]",
    "[MASKED_CASE_ID]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_CASE_NUMBER]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_CASE_REF]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_CASE_REFERENCE_NUMBER]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_CONTACT]": "[MASKED_PHONE]",
    "[MASKED_CONTACT_DETAILS]": "[MASKED_PHONE]",
    "[MASKED_CONTACT_PHONE]": "[MASKED_PHONE]",
    "[MASKED_REGISTERED_CONTACT]": "[MASKED_PHONE]",
    "[MASKED_CREATOR_NAME]": "[MASKED_NAME]",
    "[MASKED_MANAGER_NAME]": "[MASKED_NAME]",
    "[MASKED_RECRUITER_NAME]": "[MASKED_NAME]",
    "[MASKED_ID_DOC]": "[MASKED_ID_IMAGE]",
    "[MASKED_ID_DOCUMENT]": "[MASKED_ID_IMAGE]",
    "[MASKED_ID_DOCUMENT_IMAGE]": "[MASKED_ID_IMAGE]",
    "[MASKED_WAITLIST_NUMBER]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_WAITLIST_REF]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_WAITLIST_REFERENCE]": "[MASKED_CASE_REFERENCE]",
    "[MASKED_WAITLIST_REFERENCE_NUMBER]": "[MASKED_CASE_REFERENCE]",
}
BRACKET_NAMES = ("caller_name", "customer_name", "manager_name", "victim_name")
#: Whole names that say what a placeholder stands for, and parts of a name, of which the first that fits counts.
ALIAS_NAMES = {"ID_LAST4": "[MASKED_RRN]", "ID_NUMBER": "[MASKED_RRN]", "TAXPAYER_ID": "[MASKED_RRN]"}
ALIAS_PARTS = (
    (("URL", "LINK"), "[MASKED_URL]"),
    (("CREDENTIAL", "PASSWORD"), "[MASKED_CREDENTIAL]"),
    (("CONTACT", "PHONE"), "[MASKED_PHONE]"),
    (("ACCOUNT", "BANK", "PAYOUT", "PAYMENT"), "[MASKED_ACCOUNT]"),
    (("OTP", "VERIFICATION_CODE", "SECURITY_CODE"), "[MASKED_OTP]"),
    (("DOCUMENT", "IMAGE", "PHOTO", "TRANSLATION_FILE"), "[MASKED_ID_IMAGE]"),
    (("COMPANY", "BUILDING", "OFFICE", "CENTER", "TEAM", "DEPARTMENT", "CLINIC", "SCHOOL", "HOSPITAL", "INSTITUTION"), "[MASKED_COMPANY]"),
    (("NAME", "PET", "STUDENT", "OFFICER", "AGENT"), "[MASKED_NAME]"),
    (("REFERENCE", "REF", "CASE", "ORDER", "APPOINTMENT", "RECALL", "LAB", "NUMBER", "CALLBACK", "BOOK_TITLE", "FAMILY_INFO", "ROLE", "INTAKE", "PREFERENCE"), "[MASKED_CASE_REFERENCE]"),
)
BRACKET_COMPANY_PARTS = ("office", "center", "company", "clinic", "school", "hospital", "team", "department")
FORBIDDEN_TERMS = ("악성코드 설치", "피싱 사이트 제작", "인증 우회", "보안 우회", "탈취 링크")
FORBIDDEN_PUBLIC_KEYS = (
    "id", "dataset_name", "scenario_type", "context", "channel", "victim_persona", "attacker_persona", "attacker_goal", "difficulty", "protected_assets", "compromised_assets", "risk_labels", "outcome",
    "quality_checks", "safety_masks", "split", "gen_metadata", "phase", "intent_label", "risk_signal", "masked_items", "source_id", "source_record_id", "source_turn_id", "transform_name", "oracle",
)

# Turn labels.
RISK_KEYWORDS = {
    "money_transfer_request": ("송금", "이체", "결제", "입금"),
    "credential_request": ("인증", "otp", "비밀번호", "보안코드", "password", "passwd", "[masked_otp]", "[masked_credential]"),
    "identity_information_request": ("신원", "주민", "신분증", "주소", "개인정보", "생년월일", "[masked_rrn]", "[masked_phone]", "[masked_email]"),
    "callback_or_voice_sample_request": ("다시 전화", "목소리", "녹음", "통화 유지", "확인 멘트"),
    "urgency": ("지금", "급해", "긴급", "바로", "시간이 없어"),
    "authority_impersonation": ("은행", "검찰", "경찰", "기관", "보안팀", "대표", "팀장"),
    "emotional_pressure": ("엄마", "아빠", "다쳤", "사고", "도와"),
}
RISK_INTENTS = {
    "money_transfer_request": "request_masked_transfer_or_payment",
    "credential_request": "request_masked_credential_or_otp",
    "identity_information_request": "request_identity_information",
    "callback_or_voice_sample_request": "request_callback_or_voice_confirmation",
    "urgency": "escalate_urgency",
    "authority_impersonation": "assert_authority",
    "emotional_pressure": "apply_emotional_pressure",
}
DEFENSE_KEYWORDS = ("공식", "확인", "직접", "제공하지", "알려주지", "거절", "거부", "신고", "가족", "은행")
OUTCOME_DEFENSE_KEYWORDS = ("공식", "확인", "제공하지", "알려주지", "거절", "거부", "신고")
COMPROMISE_KEYWORDS = ("알려줄게", "보낼게", "이체할게", "입력할게", "입력해볼게", "접속해볼게", "인증번호 알려", "비밀번호 알려", "동의할게")
COMPLIANCE_KEYWORDS = (
    "제출할 수 있습니다", "제출하겠습니다", "제공할 수 있습니다", "제공하겠습니다", "전달할 수 있습니다", "전달하겠습니다", "전송할 수 있습니다", "전송하겠습니다", "보내드릴게요", "보내드리겠습니다",
    "보내겠습니다", "보내줄게", "제출해 보겠습니다", "제공해 보겠습니다", "전달해 보겠습니다", "전송해 보겠습니다", "입력해보겠습니다", "입력해 보겠습니다", "입력해 볼게", "입력해볼게",
    "입력하겠습니다", "접속해보겠습니다", "접속해 보겠습니다", "접속해볼게", "접속하겠습니다", "이동해 보겠습니다", "이체하겠습니다", "송금하겠습니다", "결제하겠습니다",
)
CONDITION_KEYWORDS = ("공식", "확인", "직접", "포털", "홈페이지", "등록된", "안내문", "공문서", "공식 채널", "공식 확인", "확인 절차", "후에만", "거친 후", "확인 뒤", "확인 후", "재확인")
NEGATED_DISCLOSURE = (
    r"(?U)(?:제출|제공|전달|전송|입력|공유|송금|이체|결제|접속|클릭|누르|알려주|알려드리|보내|보내드리)(?:하|할)?\s*수\s*없|"
    r"(?:제출|제공|전달|전송|입력|공유|송금|이체|결제|접속|클릭|보내|보내드리)(?:하지|하지는|하지\s*않|안\s*하|않겠|안\s*되|지|지는|지\s*않|지\s*않겠|지\s*않을|지\s*않겠습니다)|"
    r"(?:누르|알려주|알려드리)(?:지|지\s*않|지는|지\s*않겠|지\s*않을|지\s*않겠습니다)|"
    r"안\s*(?:제출|제공|전달|전송|입력|공유|송금|이체|결제|접속|클릭|누르|누를|알려주|알려줄|알려드리|알려드릴|보내|보낼|보내드리|보내드릴)"
)
REFUSAL = (
    r"(?U)(?:요청|요구|지시|안내)[^,;.?!\n]{0,40}(?:거절|거부)(?:하|합|했|할)|"
    r"(?:거절|거부)(?:하겠습니다|합니다|했습니까|할게|하겠어요|합니다)|"
    r"(?:말|답|회신|응답)하지\s*않"
)
CLAUSE_END = r"(?U)[,;.!?]\s*|(?:다만|하지만|했지만|그리고|또)(?:\s+|(?=\[MASKED_))|(?<!라)고\s+"
_CONDITION = (
    r"후에만|거친\s*후|확인\s*(?:절차|뒤|후|전)|"
    r"공식\s*(?:경로|채널|앱|포털|홈페이지)[^,;.?!\n]{0,20}(?:에서만|으로만|통해서만)|"
    r"확인(?:되면|되는\s*대로)|검증되면|승인되면|정식\s*절차가\s*끝나면"
)
COMPLIANCE_CONDITION = "(?U)" + _CONDITION
CONTRASTIVE_CONDITION = r"(?U)(?:다만|단|하지만|그러나|그런데)[^,;.?!\n]{0,80}(?:" + _CONDITION + ")"
REFUSAL_MARKERS = ("I can't assist", "I cannot assist", "I can't help", "I cannot help", "도와드릴 수 없습니다", "생성할 수 없습니다", "정책상 생성", "정책상 도와")

# What a turn asks for, and how.
PRESSURE_KEYWORDS = {
    "urgency": ("긴급", "즉시", "지금", "바로", "오늘", "마감", "기한", "분 내", "시간", "늦"),
    "authority": ("담당자", "보안팀", "관리소", "센터", "기관", "정책", "승인", "권한", "공식"),
    "relationship_emotion": ("아빠", "엄마", "가족", "걱정", "도와", "믿어", "진심", "힘들", "불안"),
    "deadline_or_loss": ("취소", "차단", "정지", "제한", "지연", "손실", "불가능", "제외", "거부"),
    "process_control": ("이 통화", "외부", "다른 경로", "공식 앱 외부", "유일", "절차", "시스템상", "처리"),
}
REQUEST_KEYWORDS = {
    "credential_or_otp_request": ("[MASKED_OTP]", "[MASKED_CREDENTIAL]", "OTP", "인증번호", "보안코드", "비밀번호", "인증"),
    "transfer_or_payment_request": ("송금", "이체", "입금", "계좌", "결제", "정산", "[MASKED_ACCOUNT]", "[MASKED_BANK_ACCOUNT]"),
    "identity_information_request": ("신분", "본인", "연락처", "등록", "문서", "번호", "[MASKED_ID", "[MASKED_CONTACT", "[MASKED_PHONE]"),
    "callback_or_voice_sample_request": ("콜백", "전화", "목소리", "음성", "통화", "[MASKED_VOICE"),
    "caller_directed_link_or_path": ("[MASKED_URL]", "[MASKED_PORTAL_URL]", "링크", "접속", "임시", "포털"),
}
NO_REQUEST, PATH_REQUEST = "none_or_context_only", "caller_directed_link_or_path"
VERIFICATION_KEYWORDS = {
    "official_app_or_portal": ("공식 앱", "공식 포털", "앱", "포털", "홈페이지", "웹사이트"),
    "saved_phone_or_known_callback": ("저장된", "직접 전화", "전화해서 확인", "고객센터", "서비스센터"),
    "trusted_person_or_manager": ("가족", "담당자", "관리자", "매니저", "선생님", "연구실"),
    "paper_or_written_notice": ("우편", "안내서", "고지서", "서면", "문서"),
}
DISCLOSURE_VERBS = ("입력하겠습니다", "제공하겠습니다", "제출하겠습니다", "전달하겠습니다", "보내드리겠습니다", "알려드리겠습니다", "처리하겠습니다")
STREAM_DISCLOSURE_VERBS = ("안내드리겠습니다", "말씀드리겠습니다", "공유하겠습니다", "알려 드리겠습니다", "알려드릴게요")
REFUSAL_KEYWORDS = ("못 보내", "제공할 수 없", "입력할 수 없", "진행할 수 없", "통화는 여기서", "마무리하겠습니다", "거절", "안 됩니다")
UNCERTAINTY_KEYWORDS = ("불안", "망설", "판단", "결정", "어렵", "확신", "정리되지", "부담")
PATH_TERMS = ("[MASKED_URL]", "링크", "접속", "임시 포털")

# Quality reports.
PRESSURE_CUES = {
    "urgency": r"(?U)긴급|급하|급해|급한|급히|급해서|지금|바로|즉시|몇\s*분|오늘\s*안|마감|기한|늦으면|서둘",
    "authority": r"담당자|기관|보안팀|관리자|정책|심사|대표|팀장|학교|은행|공식|센터|행정",
    "consequence": r"중단|보류|제한|취소|정지|불이익|문제|지연|거절",
    "relationship_or_emotional_pressure": r"가족|엄마|아빠|자녀|보호자|도와|걱정|부탁|사고|아프|믿",
    "process_control": r"통화.*유지|끊지|확인.*절차|처리.*요구|검증|제출|보완|정산|결제|인증",
}
OTP_TRANSFER = (
    r"(?U)(?:\[MASKED_OTP\]\s*(?:번)?\s*(?:으로|로)?\s*(?:입금|송금|이체|결제))|"
    r"(?:(?:입금|송금|이체|결제)\s*(?:대상|계좌|번호)?\s*(?:은|는|:)?\s*\[MASKED_OTP\])"
)
ENTITY = r"(?:[가-힣]{2,4}(?:씨|님))|(?:[가-힣A-Za-z0-9]{2,20}(?:은행|병원|학교|대학교|센터|재단|협회|보험|카드|증권|구청|시청|도서관))"
#: placeholder: (decision, normalised form)
PLACEHOLDER_DECISIONS = {
    "[MASKED_NAME]": ("allowlist_candidate", None),
    "[MASKED_COMPANY]": ("allowlist_candidate", None),
    "[MASKED_CASE_REFERENCE]": ("allowlist_candidate", None),
    "[MASKED_ID_IMAGE]": ("allowlist_candidate", None),
    "[MASKED_VOICE_SAMPLE]": ("allowlist_candidate", None),
    "[MASKED_RECRUITER_NAME]": ("normalize_to_existing", "[MASKED_NAME]"),
    "[MASKED_CREATOR_NAME]": ("normalize_to_existing", "[MASKED_NAME]"),
    "[MASKED_COMPANY_EMAIL]": ("normalize_to_existing", "[MASKED_EMAIL]"),
    "[MASKED_MANAGER_NAME]": ("normalize_to_existing", "[MASKED_NAME]"),
    "[MASKED_CONTACT]": ("normalize_to_existing", "[MASKED_PHONE]"),
    "[MASKED_CONTACT_DETAILS]": ("normalize_to_existing", "[MASKED_PHONE]"),
    "[MASKED_CASE_NUMBER]": ("normalize_to_existing", "[MASKED_CASE_REFERENCE]"),
    "[MASKED_ID_DOC]": ("normalize_to_existing", "[MASKED_ID_IMAGE]"),
    "[MASKED_WAITLIST_REFERENCE]": ("normalize_to_existing", "[MASKED_CASE_REFERENCE]"),
    "[MASKED_WAITLIST_NUMBER]": ("normalize_to_existing", "[MASKED_CASE_REFERENCE]"),
    "[MASKED_JOB_TITLE]": ("warning_keep_unstandardized", None),
    "[MASKED_LANGUAGE_SUPPORT_PORTAL]": ("warning_keep_unstandardized", None),
}
SENSITIVE_PARTS = ("CHILD", "MEMBER", "PET", "CONTACT", "HOSPITAL", "SCHOOL", "BANK", "NONPROFIT", "CLINIC", "INSTITUTION", "VOICE_SAMPLE", "ADDRESS", "BIRTH", "VIN", "ID_IMAGE")
MAX_DUPLICATE_RATE, MAX_REPAIR_RATE, MIN_TARGET_MATCH_RATE = 0.2, 0.25, 1.0

# Shortcut reports.
RESIDUE_MARKERS = ("보류하세요", "답하세요", "설명하세요", "요구하세요", "마무리하세요", "선택하세요", "제시하세요", "말하세요", "망설이세요", "끝내세요")
SHORT_UTTERANCES = ("기다리겠습니다", "보류하겠습니다", "설명만 듣겠습니다")
LEAKAGE_TERMS = ("계정 보안", "계정 확인", "업무 처리", "가족 연락", "가족 긴급", "보안 알림", "접수 상태", "정산")
