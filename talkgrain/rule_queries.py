"""Queries of the rules about words, records, plans and files, over the driver's tables.

The tables' texts hold few of the words that the rules look for. So each turn of
a conversation begins with a phrase of a fixed list, chosen by the conversation
and the turn; the SQL builds the same turns and says each rule on its own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import gates, labels, masking, text
from talkgrain.operators import quality, records, score, shortcuts, stream, validate
from talkgrain.plans import schedule, turns
from talkgrain.queries import registered, spread, table
from talkgrain.sources import jsonl

#: What turns begin with.
PHRASES = (
    "[MASKED_OTP] 제공하겠습니다", "공식 채널에서 확인 후 [MASKED_PHONE] 전달하겠습니다", "다만 확인되면 [MASKED_ACCOUNT] 전달하겠습니다", "[MASKED_PHONE]는 제공하지 않겠습니다",
    "[MASKED_OTP] 입력하지 않고 [MASKED_PHONE] 전달하겠습니다", "그 요청은 거절하겠습니다", "지금 인증번호를 입력해 주세요", "은행 보안팀 담당자입니다", "링크 [MASKED_URL]로 접속해 주세요", "엄마 사고가 났어요, 도와 주세요",
    "중단되면 불이익이 있습니다", "저장된 번호로 직접 전화해 보겠습니다", "망설여지고 판단이 어렵습니다", "[MASKED_CREDENTIAL] 맞나요", "인증번호 알려 드릴게, 보낼게", "설명만 듣겠습니다", "김민수님 한국은행 [한숨] 네",
    "[MASKED_OTP]로 송금해 주세요", "우편 안내서를 확인하겠습니다", "하지만[MASKED_PHONE] 보내드릴게요!", "공식 앱에서 확인 후에만 [MASKED_ACCOUNT] 제출하겠습니다", "[MASKED_MEMBER_STATUS] 말씀드리겠습니다",
    "알림 알림 부탁드립니다", "안녕하세요", "보안 우회 방법은 모릅니다", "도와드릴 수 없습니다", "통화 종료", "피해자 확인 절차", "신고하고 기록을 보존하겠습니다",
)
RISKS = ("urgency", "victim_resistance", "", "asset_disclosure", "generation_fallback", "authority_impersonation", "credential_request")


def _said(values: tuple[str, ...], place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(place, F.lit(len(values))) + 1).cast("int"))


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_id, turn_id, speaker, phrase, utterance, risk_signal``."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    phrase = _said(PHRASES, conv * 5 + turn * 7)
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("stream_id"), (F.col("turn") + 1).cast("int").alias("turn_id"), F.when(turn % 2 == 0, "attacker").otherwise("victim").alias("speaker"),
        phrase.alias("phrase"), F.concat(phrase, F.lit(" "), F.coalesce("text", F.lit(""))).alias("utterance"), _said(RISKS, conv + turn).alias("risk_signal"),
    )


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_SPOKEN = f"""WITH t AS (SELECT conv_id::VARCHAR AS stream_id, (turn + 1)::INT AS turn_id, CASE WHEN turn % 2 = 0 THEN 'attacker' ELSE 'victim' END AS speaker,
  {_list(PHRASES)}[((conv_id * 5 + turn * 7) % {len(PHRASES)})::INT + 1] AS phrase, {_list(RISKS)}[((conv_id + turn) % {len(RISKS)})::INT + 1] AS risk_signal, COALESCE(text, '') AS said FROM conversations),
u AS (SELECT *, phrase || ' ' || said AS utterance FROM t)
"""


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"""contains({c}, '{w.replace("'", "''")}')""" for w in words) + ")"


def _re(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, '{pattern.replace('(?U)', '')}')"


def _first(c: str, lexicon: dict) -> str:
    return "CASE " + " ".join(f"WHEN {_any(c, words)} THEN '{name}'" for name, words in lexicon.items()) + " END"


def _names(c: str, lexicon: dict, sort: bool = True, test=_any) -> str:
    found = ", ".join(f"CASE WHEN {test(c, words)} THEN '{name}' END" for name, words in lexicon.items())
    kept = f"list_filter([{found}], lambda x: x IS NOT NULL)"
    return f"array_to_string({f'list_sort({kept})' if sort else kept}, ',')"


_MASK = r"\[MASKED_[A-Z0-9_]+\]"
_HAS = lambda c: _re(c, _MASK)
_REFUSES = lambda c: f"({_re(c, K.NEGATED_DISCLOSURE)} OR {_re(c, K.REFUSAL)})"
_COMPLIES = lambda c: _any(f"lower({c})", K.COMPLIANCE_KEYWORDS)
# No look-around there: the word that ends in the syllable is put aside first, and words before a mask are ends of their own.
_CLAUSES = r"""string_split(replace(regexp_replace(regexp_replace(replace(utterance, '라고', '라¤'), '[,;.!?]\s*|(다만|하지만|했지만|그리고|또)\s+|고\s+', '‖', 'g'), '(다만|하지만|했지만|그리고|또)(\[MASKED_)', '‖\2', 'g'), '라¤', '라고'), '‖')"""
_SCOPED = K.COMPLIANCE_CONDITION
_RULES = _SPOKEN + f""", c AS (SELECT *, {_CLAUSES} AS clauses, {_HAS('utterance')} AND {_COMPLIES('utterance')} AS partial FROM u),
r AS (SELECT *, len(list_filter(clauses, lambda c: {_HAS('c')} AND NOT {_REFUSES('c')} AND {_COMPLIES('c')})) > 0 AND partial AS open,
  {_re('utterance', _SCOPED)} AND ({_re('utterance', K.CONTRASTIVE_CONDITION)} OR len(list_filter(clauses, lambda c: {_HAS('c')} AND {_re('c', _SCOPED)} AND {_COMPLIES('c')})) > 0) AS conditional,
  len(list_filter(clauses, lambda c: NOT {_REFUSES('c')} AND {_any('lower(c)', K.COMPROMISE_KEYWORDS)})) > 0 AS yields,
  list_filter(clauses, lambda c: {_HAS('c')} AND {_COMPLIES('c')}) AS about FROM c)
"""


@registered(_RULES + f"""SELECT stream_id, turn_id, len(clauses)::INT AS clauses, {_REFUSES('utterance')} AS refuses, partial, open, {_any('utterance', K.CONDITION_KEYWORDS)} AS verifies, conditional,
  partial AND len(about) > 0 AND len(list_filter(about, lambda c: NOT {_REFUSES('c')})) = 0 AS only_refuses, NOT conditional AND (open OR yields) AS compromise FROM r""")
def disclosure_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("utterance")
    return spoken(spark, sf_dir).select(
        "stream_id", "turn_id", F.size(labels.clauses(c)).alias("clauses"), labels.refuses(c).alias("refuses"), labels.partly_complies(c).alias("partial"), labels.complies_unconditionally(c).alias("open"),
        labels.mentions_verification(c).alias("verifies"), labels.complies_on_condition(c).alias("conditional"), labels.only_refuses_compliance(c).alias("only_refuses"), labels.is_compromise(c).alias("compromise"),
    )


@registered(_SPOKEN + f"""SELECT stream_id, turn_id, {_names('utterance', K.PRESSURE_CUES, False, _re)} AS cues, {_names('utterance', K.PRESSURE_KEYWORDS)} AS pressures, COALESCE({_first('utterance', K.REQUEST_KEYWORDS)}, '{K.NO_REQUEST}') AS request,
  COALESCE(NULLIF({_names('utterance', K.REQUEST_KEYWORDS)}, ''), '{K.NO_REQUEST}') AS requests, COALESCE({_first('utterance', K.VERIFICATION_KEYWORDS)}, CASE WHEN {_any('utterance', ('공식', '확인'))} THEN 'unclear' ELSE 'absent' END) AS path,
  {_any('utterance', K.PATH_TERMS)} AS names_path FROM u""")
def caller_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("utterance")
    joined = lambda a: F.array_join(a, ",")
    return spoken(spark, sf_dir).select(
        "stream_id", "turn_id", joined(labels.pressure_cues(c)).alias("cues"), joined(labels.pressure_categories(c)).alias("pressures"), labels.request_state(c).alias("request"), joined(labels.request_states(c)).alias("requests"),
        labels.verification_path(c).alias("path"), labels.names_path(c).alias("names_path"),
    )


_STATES = _SPOKEN + f""", d AS (SELECT *, contains(utterance, '공식') AND {_any('utterance', ('후', '확인'))} AS official, {_HAS('utterance')} AS masked FROM u),
e AS (SELECT *, CASE WHEN masked AND {_any('utterance', K.DISCLOSURE_VERBS)} THEN CASE WHEN official THEN 'conditional_masked_action' ELSE 'direct_masked_disclosure_or_entry' END
  WHEN masked AND {_any('utterance', ('맞나요', '확인'))} THEN 'asset_mentioned_without_commitment' ELSE 'none' END AS disclosure FROM d),
f AS (SELECT *, CASE WHEN disclosure <> 'none' THEN disclosure WHEN NOT contains(utterance, '[MASKED_') THEN 'none' WHEN official THEN 'conditional_masked_action' WHEN {_any('utterance', K.STREAM_DISCLOSURE_VERBS)} THEN 'direct_masked_disclosure_or_entry' ELSE 'none' END AS in_stream,
  CASE WHEN disclosure = 'direct_masked_disclosure_or_entry' THEN 'risky_or_unsafe' WHEN {_any('utterance', K.UNCERTAINTY_KEYWORDS)} OR disclosure = 'conditional_masked_action' THEN 'uncertain_or_conditional'
    WHEN {_any('utterance', (*K.REFUSAL_KEYWORDS, '직접'))} OR (contains(utterance, '공식') AND contains(utterance, '확인')) THEN 'safe_verify_or_refuse' ELSE 'needs_audit' END AS defense FROM e)
"""


@registered(_STATES + "SELECT stream_id, turn_id, disclosure, in_stream, defense FROM f")
def recipient_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("utterance")
    return spoken(spark, sf_dir).select("stream_id", "turn_id", labels.disclosure_state(c).alias("disclosure"), labels.stream_disclosure_state(c).alias("in_stream"), labels.defense_action(c).alias("defense"))


@registered(_STATES + """, l AS (SELECT stream_id, arg_max(disclosure, turn_id) AS d, arg_max(defense, turn_id) AS a FROM f GROUP BY stream_id)
SELECT stream_id, CASE WHEN d = 'direct_masked_disclosure_or_entry' OR a = 'risky_or_unsafe' THEN 'unsafe_commitment' WHEN d = 'conditional_masked_action' OR a = 'uncertain_or_conditional' THEN 'conditional_needs_verification'
  WHEN a = 'safe_verify_or_refuse' THEN 'safe_contained' ELSE 'insufficient_evidence' END AS terminal FROM l""")
def terminal_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("utterance")
    point = F.struct("turn_id", labels.defense_action(c).alias("recipient_defense_action"), labels.disclosure_state(c).alias("disclosure_state"))
    return spoken(spark, sf_dir).groupBy("stream_id").agg(F.array_sort(F.collect_list(point)).alias("points")).select("stream_id", labels.terminal_state(F.col("points")).alias("terminal"))


@registered(_SPOKEN + f"""SELECT stream_id, turn_id, phrase AS model_answer, replace(phrase, '알림 알림', '알림') AS planner_answer, md5(lower(regexp_replace(utterance, '\\s+', '', 'g'))) AS key, len(regexp_extract_all(phrase, '{_MASK}'))::INT AS masks,
  contains(phrase, '[한숨]') AS unknown_bracket, len(regexp_extract_all(regexp_replace(utterance, '{_MASK}', ' ', 'g'), '[가-힣]'))::INT AS hangul, regexp_matches(utterance, '[가-힣]') AS has_hangul,
  regexp_replace(phrase, '{_MASK}', '[MASKED_VALUE]', 'g') AS neutral, regexp_replace(phrase, '{_MASK}', '[MASKED]', 'g') AS ablated, CASE WHEN {_any('phrase', K.SHORT_UTTERANCES)} OR len(regexp_extract_all(regexp_replace(phrase, '{_MASK}', ' ', 'g'), '[가-힣]')) < 9
    THEN 'very_short_utterance' END AS artifact, {_any('phrase', K.FORBIDDEN_TERMS)} AS forbidden FROM u""")
def utterance_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, p = F.col("utterance"), F.col("phrase")
    framed = _said(("<think>who knows</think> ", "attacker: ", "```\n", "[웃음] "), F.col("turn_id"))
    return spoken(spark, sf_dir).select(
        "stream_id", "turn_id", text.clean_model_utterance(F.concat(framed, p)).alias("model_answer"), text.clean_utterance(F.concat(F.lit("“피해자: "), p, F.lit("”"))).alias("planner_answer"), F.md5(text.duplicate_key(c)).alias("key"),
        F.size(text.placeholders(p)).alias("masks"), text.has_unknown_bracket(p).alias("unknown_bracket"), text.hangul_length(c).cast("int").alias("hangul"), text.has_hangul(c).alias("has_hangul"), text.surface_text(p, "neutral_mask").alias("neutral"),
        text.surface_text(p, "placeholder_ablated").alias("ablated"), text.utterance_artifact(p).alias("artifact"), masking.has_forbidden_detail(p).alias("forbidden"),
    )


_SENTENCES = r"list_filter(list_transform(regexp_extract_all(utterance, '[^.!?\n。！？]+[.!?。！？]?'), lambda x: trim(x, E' \t\r')), lambda x: x <> '')"


@registered(_SPOKEN + f"""SELECT stream_id, turn_id, md5(array_to_string({_SENTENCES}, ' ')) AS joined, list_filter({_SENTENCES}, lambda s: {_any('s', K.REFUSAL_KEYWORDS + ('공식',))})[1] AS evidence, contains(utterance, phrase) AS exact FROM u""")
def evidence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("utterance")
    return spoken(spark, sf_dir).select("stream_id", "turn_id", F.md5(text.joined_sentences(text.sentences(c))).alias("joined"), text.evidence_sentence(c, (*K.REFUSAL_KEYWORDS, "공식")).alias("evidence"), text.is_exact_evidence(F.col("phrase"), c).alias("exact"))


# Records.

_LABELS = {placeholder: label for label, placeholder, _ in K.MASKS}


def spoken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations of phrases as records, with the fields that reports read."""
    kind = "array<struct<label:string,placeholder:string>>"
    standard = F.filter(text.placeholders(F.col("phrase")), lambda p: p.isin(*_LABELS))
    known = F.create_map(*[F.lit(x) for pair in _LABELS.items() for x in pair])
    masks = F.transform(standard, lambda p: F.struct(F.element_at(known, p).alias("label"), p.alias("placeholder"))).cast(kind)
    turn = F.struct("turn_id", "speaker", F.col("phrase").alias("utterance"), "risk_signal", masks.alias("masked_items"))
    rows = spoken(spark, sf_dir).groupBy("stream_id").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"))
    k = F.col("stream_id").cast("bigint")
    blank = lambda c, n: F.when(k % n == 0, F.lit(" \t")).otherwise(c)
    context = F.struct(*[blank(F.concat(F.lit(f"{f}-"), (k % (j + 2)).cast("string")), j + 3).alias(f) for j, f in enumerate(K.CONTEXT_FIELDS)])
    meta = F.struct(
        blank(_said(K.PRESSURE_STYLES, k), 11).alias("pressure_style"), blank(_said(K.TARGET_OUTCOME_MODES, k), 7).alias("target_outcome_mode"), (k % 6 == 1).alias("target_outcome_repair_applied"), F.lit(None).cast("boolean").alias("target_outcome_deterministic_repair_applied"),
        (k % 8 == 1).alias("target_outcome_llm_rewrite_applied"), (k % 3 + 1).alias("target_outcome_generation_attempts"), (k % 2).alias("target_outcome_llm_rewrite_attempts"), context.alias("environmental_context"),
    )
    person = lambda n, p: F.struct(F.concat(F.lit(p), (k % n).cast("string")).alias("id"))
    return rows.select(
        F.col("stream_id").alias("id"), "dialogue", _said(("attack", "benign", "borderline"), k).alias("label"), F.when(k % 5 == 0, "en-US").otherwise("ko-KR").alias("locale"), F.array(_said(RISKS, k)).alias("risk_labels"),
        F.concat(F.lit("scenario-"), (k % 4).cast("string")).alias("scenario_type"), _said(("defended_success", "inconclusive", "compromised"), F.floor(k / 2)).alias("outcome"), meta.alias("gen_metadata"), records.safety_masks(F.col("dialogue")).alias("safety_masks"),
        person(5, "v").alias("victim_persona"), person(3, "a").alias("attacker_persona"),
    )


_RECORDS = _SPOKEN + f""", r AS (SELECT stream_id AS id, any_value(stream_id::BIGINT) AS k, list(phrase ORDER BY turn_id) AS said, list(speaker ORDER BY turn_id) AS speakers, list(risk_signal ORDER BY turn_id) AS risks,
  list_sort(list_distinct(COALESCE(list(risk_signal) FILTER (speaker = 'attacker' AND risk_signal NOT IN ('', 'generation_fallback')), []))) AS seen, bool_or({_any('phrase', K.REFUSAL_MARKERS)}) AS leak, bool_and(regexp_matches(phrase, '[가-힣]')) AS korean FROM u GROUP BY stream_id),
q AS (SELECT *, {_list(('attack', 'benign', 'borderline'))}[(k % 3)::INT + 1] AS label, {_list(RISKS)}[(k % {len(RISKS)})::INT + 1] AS risk, 'scenario-' || (k % 4) AS scenario_type, {_list(('defended_success', 'inconclusive', 'compromised'))}[((k // 2) % 3)::INT + 1] AS outcome,
  CASE WHEN k % 11 = 0 THEN NULL ELSE {_list(K.PRESSURE_STYLES)}[(k % 5)::INT + 1] END AS style, CASE WHEN k % 7 = 0 THEN NULL ELSE {_list(K.TARGET_OUTCOME_MODES)}[(k % 3)::INT + 1] END AS target FROM r)
"""


@registered(_RECORDS + f""", e AS (SELECT *, list_filter(range(1, len(said) + 1), lambda n: n >= 6 AND speakers[n] = 'victim' AND (risks[n] IN ('victim_resistance', 'asset_disclosure') OR contains(said[n], '종료')))[1] AS ends FROM q)
SELECT id, NOT leak AS no_leak, CASE label WHEN 'attack' THEN list_contains(seen, risk) WHEN 'benign' THEN len(seen) = 0 ELSE true END AS labels_fit, k % 5 = 0 OR korean AS language_fits, COALESCE(ends, len(said))::INT AS turns_to_end,
  array_to_string(list_sort(list_distinct(list_concat([risk], seen))), ',') AS risks, len(regexp_extract_all(array_to_string(said, ''), '\\[MASKED_(OTP|PHONE|ACCOUNT|URL|CREDENTIAL|RRN|EMAIL)\\]'))::INT AS masks,
  list_contains(list_transform(said, lambda s: replace(s, ' ', '')), replace(said[1], ' ', '')) AS repeats FROM e""")
def record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("dialogue")
    return spoken_records(spark, sf_dir).select(
        "id", records.no_refusal_leak(d).alias("no_leak"), records.label_consistent(F.col("label"), d, F.col("risk_labels")).alias("labels_fit"), records.language_consistent(d, F.col("locale")).alias("language_fits"),
        F.size(records.up_to_end(d)).alias("turns_to_end"), F.array_join(records.risk_labels(d, F.col("risk_labels")), ",").alias("risks"), F.size(masking.exported_masks(records.safety_masks(d))).alias("masks"),
        records.repeats_a_turn(F.get(d, 0)["utterance"], d).alias("repeats"),
    )


@registered(_RECORDS + "SELECT label, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(array_to_string(said, ''), '\\[MASKED_(OTP|PHONE|ACCOUNT|URL|CREDENTIAL|RRN|EMAIL)\\]', 1))) AS label FROM q) GROUP BY label")
def mask_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mask_counts(spoken_records(spark, sf_dir))


_CUES = ", ".join(f"CASE WHEN {_re('x', p)} THEN '{n}' END" for n, p in K.PRESSURE_CUES.items())


@registered(_RECORDS + f""", x AS (SELECT style, array_to_string(list_filter(said, lambda s, i: i % 2 = 1), ' ') AS x FROM q WHERE style IS NOT NULL), s AS (SELECT style, list_filter([{_CUES}], lambda c: c IS NOT NULL) AS cues FROM x)
SELECT count(*) AS assigned, count(*) FILTER (list_contains(cues, style)) AS matches, count(*) FILTER (style <> 'urgency' AND list_contains(cues, 'urgency')) AS urgency_leaks FROM s""")
def style_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.style_alignment(spoken_records(spark, sf_dir))


@registered(_RECORDS + """, m AS (SELECT *, CASE WHEN target = 'masked_compromise' THEN outcome = 'compromised' ELSE outcome = target END AS matches FROM q WHERE target IS NOT NULL)
SELECT count(*) AS assigned, count(*) FILTER (matches) AS matches, count(*) FILTER (k % 6 = 1) AS repaired, count(*) FILTER (k % 8 = 1) AS rewritten, count(*) FILTER (matches AND k % 6 <> 1 AND k % 8 <> 1 AND k % 3 + 1 > 1) AS retried FROM m""")
def target_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.target_alignment(spoken_records(spark, sf_dir))


@registered(_RECORDS + f""", c AS (SELECT unnest({_list(K.CONTEXT_FIELDS)}) AS field, unnest(range(len({_list(K.CONTEXT_FIELDS)}))) AS j, k FROM q)
SELECT field, count(*) FILTER (k % (j + 3) <> 0) AS present, count(*) FILTER (k % (j + 3) = 0) AS missing, count(DISTINCT k % (j + 2)) FILTER (k % (j + 3) <> 0) AS distinct FROM c GROUP BY field""")
def context_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contexts(spoken_records(spark, sf_dir))


@registered(_RECORDS + """, d AS (SELECT *, CASE scenario_type WHEN 'scenario-0' THEN ['authority_impersonation', 'urgency'] WHEN 'scenario-1' THEN ['urgency'] ELSE ['voice_impersonation'] END AS usual FROM q)
SELECT count(*) AS records, count(*) FILTER (usual <> seen) AS mismatches, count(*) FILTER (len(seen) = 0) AS without_risk, count(*) FILTER (label <> 'attack') AS non_attack_count FROM d""")
def risk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spoken_records(spark, sf_dir)
    defaults = spark.createDataFrame([("scenario-0", ["urgency", "authority_impersonation"]), ("scenario-1", ["urgency"])], "scenario_type string, risks array<string>")
    return quality.risk_coverage(rows, defaults).crossJoin(quality.not_attacks(rows))


@registered(_RECORDS + "SELECT id, scenario_type, 'scenario-' || (k % 3) AS expected FROM q WHERE k % 5 < 4 AND scenario_type <> 'scenario-' || (k % 3)")
def pair_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.createDataFrame([(f"v{v}", f"a{a}", f"scenario-{a}") for v in range(4) for a in range(3)], "victim_id string, attacker_id string, expected string")
    return quality.pair_mismatches(spoken_records(spark, sf_dir), pairs).select("id", "scenario_type", "expected")


@registered(_SPOKEN + f"""SELECT unnest({_list(K.PRESSURE_CUES)}) AS cue, unnest([{', '.join(f"count(*) FILTER ({_re('utterance', p)})" for p in K.PRESSURE_CUES.values())}]) AS n FROM u WHERE speaker = 'attacker'""")
def cue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cue_diversity(spoken(spark, sf_dir), order="turn_id")[1].select("cue", "n")


@registered(_SPOKEN + f"""SELECT count(*) AS attacker_turns, count(*) FILTER ({' OR '.join(_re('utterance', p) for p in K.PRESSURE_CUES.values())}) AS with_cue, count(*) FILTER ({_re('utterance', K.PRESSURE_CUES['urgency'])}) AS urgent FROM u WHERE speaker = 'attacker'""")
def cue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cue_diversity(spoken(spark, sf_dir), order="turn_id")[0]


@registered(_SPOKEN + f"""SELECT count(*) FILTER (contains(phrase, '[한숨]')) AS stage_direction_count, count(*) FILTER ({_re('phrase', K.OTP_TRANSFER)}) AS mask_usage_anomaly_count, count(*) FILTER (contains(phrase, '[MASKED_MEMBER_STATUS]')) AS unknown_masked_placeholder_count,
  count(*) FILTER (speaker = 'victim' AND {_HAS('phrase')} AND {_COMPLIES('phrase')}) AS partial_compliance_signal_count, count(*) FILTER ({_re(f"regexp_replace(phrase, '{_MASK}', '', 'g')", K.ENTITY)}) AS korean_entity_warning_count FROM u""")
def signal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.signal_counts(spoken(spark, sf_dir).select("stream_id", "turn_id", "speaker", F.col("phrase").alias("utterance")))


@registered(_SPOKEN + """SELECT stream_id AS record_id, turn_id, phrase AS utterance FROM u WHERE contains(phrase, '[한숨]') ORDER BY stream_id::BIGINT, turn_id LIMIT 10""")
def first_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the first ten turns with a stage direction."""
    rows = spoken(spark, sf_dir).select(F.col("stream_id").alias("record_id"), "turn_id", "speaker", F.col("phrase").alias("utterance"), F.struct(F.col("stream_id").cast("bigint"), "turn_id").alias("place"))
    return quality.examples(rows, F.col("utterance").rlike(K.STAGE_DIRECTION), order="place")


@registered("""SELECT event_type AS value, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type ORDER BY n DESC, first LIMIT 20""")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the most frequent values, of equals the one that came first."""
    return quality.most_common(table(spark, sf_dir, "events"), "event_type", order="event_id").withColumnRenamed("event_type", "value")


@registered(_SPOKEN + f""", n AS (SELECT *, regexp_replace(phrase, '{_MASK}', '', 'g') AS bare FROM u) SELECT turn_id, CASE WHEN {_any('phrase', K.RESIDUE_MARKERS)} THEN 'residue' ELSE 'clean' END AS residue,
  count(*) AS n, count(*) FILTER (trim(bare) = '') AS empty FROM n GROUP BY ALL""")
def residue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    residue = F.when(text.contains_any(F.col("phrase"), K.RESIDUE_MARKERS), "residue").otherwise("clean")
    return spoken(spark, sf_dir).groupBy("turn_id", residue.alias("residue")).agg(F.count("*").alias("n"), F.count_if(text.is_placeholder_only(F.col("phrase"))).alias("empty"))


# Plans and schedules.

_GOALS = ("credential_capture", "money_transfer", "voice_sample_or_callback", "other_goal")
_PLAN_ROWS = ", ".join(
    f"('{profile}', '{name}', {k}, '{event}', '{slot}', {evidence})" for profile, plans in turns.PLANS.items() for name, plan in [*enumerate(plans), ("canonical", plans[0])] for k, (event, slot, evidence) in enumerate((*turns.OPENING, *plan), 1)
)
_USUAL = " ".join(f"WHEN '{e}' THEN '{a}'" for e, a in K.EVENT_ACTION.items())


@registered(f"""WITH c AS (SELECT c_custkey AS k, {_list(K.PROFILES)}[(c_custkey % 5)::INT + 1] AS profile, CASE WHEN c_custkey % 7 = 6 THEN 'canonical' ELSE (c_custkey % 7)::VARCHAR END AS variant, {_list(_GOALS)}[((c_custkey // 35) % 4)::INT + 1] AS goal,
  CASE WHEN c_custkey % 9 = 0 THEN 'bank book' WHEN c_custkey % 9 = 1 THEN 'a Password' ELSE 'house' END AS asset FROM customer),
p AS (SELECT * FROM (VALUES {_PLAN_ROWS}) v(profile, variant, turn_id, event, slot, evidence)),
s AS (SELECT *, turn_id % 2 = 1 AS caller, CASE slot WHEN 'link' THEN '[MASKED_URL]' WHEN 'phone' THEN '[MASKED_PHONE]' WHEN 'goal' THEN CASE WHEN goal = 'credential_capture' OR lower(asset) LIKE '%password%' THEN '[MASKED_CREDENTIAL]'
    WHEN goal = 'money_transfer' OR asset LIKE '%bank%' THEN '[MASKED_ACCOUNT]' ELSE '[MASKED_PHONE]' END END AS shown,
  CASE goal WHEN 'credential_capture' THEN 'credential_request' WHEN 'money_transfer' THEN 'money_transfer_request' WHEN 'voice_sample_or_callback' THEN 'callback_or_voice_sample_request' ELSE 'identity_information_request' END AS goal_risk FROM c JOIN p USING (profile, variant)),
f AS (SELECT *, CASE WHEN caller THEN CASE WHEN event IN ('pressure_escalation', 'pressure_only_monitor') THEN 'urgency' WHEN slot = 'goal' THEN goal_risk WHEN slot <> '' THEN 'identity_information_request' ELSE 'authority_impersonation' END
    WHEN event IN ('recipient_containment', 'recovery_followup_due') THEN 'victim_resistance' WHEN event = 'recipient_partial_or_direct_disclosure' THEN 'asset_disclosure' ELSE 'victim_uncertainty' END AS risk,
  CASE WHEN caller THEN CASE WHEN event = 'pressure_escalation' THEN 'escalate_urgency' WHEN slot <> '' THEN 'request_identity_information' ELSE 'social_engineering_probe' END
    WHEN event IN ('recipient_containment', 'recovery_followup_due') THEN 'resist_or_verify_request' WHEN event = 'recipient_partial_or_direct_disclosure' THEN 'disclose_or_comply' ELSE 'uncertain_response' END AS intent FROM s)
SELECT profile, variant, turn_id, event, intent AS intent_label, risk AS risk_signal, shown AS placeholder, CASE WHEN variant = 'canonical' THEN CASE event {_USUAL} END ELSE CASE event
    WHEN 'needs_more_context' THEN CASE WHEN caller THEN 'no_alert' ELSE 'monitor_only' END
    WHEN 'no_new_actionable_event' THEN CASE WHEN caller OR (turn_id > 4 AND (profile, variant, turn_id) IN (('caller_directed_path', '3', 6), ('caller_directed_path', '4', 6), ('partial_disclosure_recovery', '4', 6), ('pressure_escalation', '5', 6))) THEN 'no_alert' ELSE 'monitor_only' END
    WHEN 'pressure_only_monitor' THEN CASE WHEN turn_id >= 5 THEN 'pause_or_verify' ELSE 'monitor_only' END
    WHEN 'new_sensitive_request' THEN CASE WHEN shown IN ('[MASKED_CREDENTIAL]', '[MASKED_ACCOUNT]') OR turn_id >= 5 THEN 'refuse_or_pause' ELSE 'pause_or_verify' END
    WHEN 'new_caller_directed_path' THEN CASE WHEN turn_id IN (5, 8) THEN 'refuse_or_pause' ELSE 'pause_or_verify' END
    WHEN 'pressure_escalation' THEN CASE WHEN turn_id >= 7 THEN 'pause_or_verify' ELSE 'monitor_only' END
    WHEN 'recipient_containment' THEN CASE WHEN turn_id >= 8 AND shown IS NULL THEN 'no_alert' ELSE 'monitor_only' END
    WHEN 'recipient_partial_or_direct_disclosure' THEN CASE WHEN turn_id <= 4 THEN 'pause_or_verify' ELSE 'preserve_and_report' END
    ELSE CASE WHEN caller THEN 'refuse_or_pause' ELSE 'preserve_and_report' END END END AS action, evidence::INT AS evidence, count(*) AS n
FROM f GROUP BY ALL""")
def planned_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    variant = F.when(k % 7 == 6, "canonical").otherwise((k % 7).cast("string"))
    assets = F.array(F.when(k % 9 == 0, "bank book").when(k % 9 == 1, "a Password").otherwise("house"))
    rows = table(spark, sf_dir, "customer").select(k.cast("string").alias("record_id"), _said(K.PROFILES, k).alias("profile"), variant.alias("variant"), _said(_GOALS, F.floor(k / 35)).alias("goal"), assets.alias("protected_assets"))
    keys = ("profile", "variant", "turn_id", "event", "intent_label", "risk_signal", "placeholder", "action")
    return turns.planned_turns(rows).groupBy(*keys, F.get("evidence_turn_ids", 0).alias("evidence")).agg(F.count("*").alias("n"))


@registered(f"""WITH i AS (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer)
SELECT k, {_list(K.DIFFICULTIES)}[(k % 3)::INT + 1] AS sophistication, {_list(K.DIFFICULTIES)}[((k // 3) % 3)::INT + 1] AS susceptibility,
  CASE k % 4 WHEN 0 THEN 'partial_disclosure' WHEN 1 THEN 'uncertain' WHEN 2 THEN 'defensive' ELSE CASE (k // 3) % 3 WHEN 2 THEN 'partial_disclosure' WHEN 1 THEN 'uncertain' ELSE 'defensive' END END AS response,
  CASE WHEN k % 3 = 0 THEN 'money_transfer' WHEN segment LIKE '%B%' THEN 'credential_capture' ELSE 'identity_information' END AS goal, CASE WHEN k % 2 = 0 THEN 'mail' ELSE 'phone' END AS channel, 'dusk' AS timing,
  'n' || k AS persona_name, '' AS persona_text, CASE k % 5 WHEN 2 THEN 'compromised' WHEN 3 THEN 'inconclusive' WHEN 4 THEN 'inconclusive' ELSE 'defended_success' END AS expected FROM i""")
def planned_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    target = F.when(k % 4 == 0, "masked_compromise").when(k % 4 == 1, "inconclusive").when(k % 4 == 2, "defended_success")
    difficulty = schedule.difficulty_for_index(k)
    goals = F.when(k % 3 == 0, F.array(F.lit("money_transfer"))).otherwise(F.array().cast("array<string>"))
    assets = F.array(F.when(F.col("c_mktsegment").contains("B"), "otp").otherwise("house"))
    base, variant = (F.struct(*[value(f).alias(f) for f in K.CONTEXT_FIELDS]) for value in (lambda f: F.lit("phone" if f == "channel" else "dusk"), lambda f: F.when(k % 2 == 0, "mail") if f == "channel" else F.lit(None).cast("string")))
    setting, person = schedule.overlay(base, variant), schedule.compact_persona(F.struct(F.concat(F.lit("n"), k.cast("string")).alias("id"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("description")))
    # Of five profiles the third says compromised, the fourth and fifth inconclusive, whatever was seen.
    observed = F.when(k % 2 == 0, "compromised").otherwise("defended_success")
    return table(spark, sf_dir, "customer").select(
        k.alias("k"), difficulty["attacker_sophistication"].alias("sophistication"), difficulty["victim_susceptibility"].alias("susceptibility"), schedule.response_mode(target, difficulty["victim_susceptibility"]).alias("response"),
        schedule.attacker_goal(goals, assets).alias("goal"), setting["channel"].alias("channel"), setting["timing"].alias("timing"), person["name"].alias("persona_name"), person["description"].alias("persona_text"), turns.expected_outcome(_said(K.PROFILES, k), observed).alias("expected"),
    )


@registered("""WITH i AS (SELECT range AS index FROM range(500)), v AS (SELECT n_nationkey AS pos, n_name AS id FROM nation), a AS (SELECT r_regionkey AS pos, r_name AS id FROM region),
s AS (SELECT index, v.id AS victim_id, a.id AS attacker_id, CASE WHEN v.id = 'NATION_8' AND a.id = 'ASIA' THEN 'pair_only' WHEN a.id = 'EUROPE' THEN 'two' WHEN v.id = 'NATION_6' THEN 'one' ELSE ['one', 'two', 'one'][index % 3 + 1] END AS scenario_type
  FROM i JOIN v ON v.pos = index % 25 JOIN a ON a.pos = (index // 25 + index) % 5)
SELECT index, victim_id, attacker_id, scenario_type FROM s WHERE index % 3 <> 0 ORDER BY index LIMIT 200""")
def scheduled_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences of pairs and personas, and what a resumed run has left: every third record is there."""
    victims = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("id"))
    attackers = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("pos"), F.col("r_name").alias("id"))
    scenarios = spark.createDataFrame([(0, "one"), (1, "two"), (2, "pair_only")], "pos int, scenario string")
    pairs = spark.createDataFrame([("NATION_8", "ASIA", "pair_only"), ("NATION_9", "ASIA", "unknown")], "victim_id string, attacker_id string, preferred string")
    prefer = lambda *rows: spark.createDataFrame(rows, "id string, preferred string")
    rows = schedule.schedule(spark, victims, attackers, scenarios, count=500, pair_scenarios=pairs, attacker_scenarios=prefer(("EUROPE", "two"), ("AFRICA", "pair_only")), victim_scenarios=prefer(("NATION_6", "one")), pair_only=("pair_only",))
    there = rows.where("index % 3 = 0").select(F.col("record_id").alias("id"))
    return schedule.not_yet_written(rows, there, 200).select("index", "victim_id", "attacker_id", "scenario_type")


# The contract and the predictions.

_FLAGS = ", ".join(f'"{f}": true' for f in K.QUALITY_FLAGS)


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON record for each customer, of which one thing in fifteen is wrong."""
    person = '{"id": "p"}'
    fields = {f: '"x"' for f in K.RECORD_FIELDS} | {
        "victim_persona": person, "attacker_persona": person, "protected_assets": '["otp"]', "compromised_assets": "[]", "difficulty": "{}", "label": '"attack"', "outcome": '"inconclusive"', "split": '"train"', "risk_labels": '["urgency"]',
        "safety_masks": "[]", "gen_metadata": "{}", "quality_checks": f'{{"turn_count": 1, {_FLAGS}}}', "dialogue": '[{"turn_id": 1, "speaker": "attacker", "phase": "opening", "utterance": "u", "intent_label": "i", "risk_signal": "r", "masked_items": []}]',
    }
    whole = "{" + ", ".join(f'"{f}": {v}' for f, v in fields.items()) + "}"
    edits = (
        ("", ""), ('"channel": "x", ', ""), ('"dialogue": [{', '"dialogue": [], "d": [{'), ('"protected_assets": ["otp"]', '"protected_assets": []'), ('"risk_labels": ["urgency"]', '"risk_labels": ["\\\\t"]'), ('"label": "attack"', '"label": "war"'),
        ('"split": "train"', '"split": "all"'), ('"safety_masks": []', '"safety_masks": [{"label": "otp", "placeholder": "x", "original": "1"}]'), ('"gen_metadata": {}', '"gen_metadata": 3'), ('"turn_id": 1', '"turn_id": 2'), ('"speaker": "attacker"', '"speaker": "victim"'),
        ('"masked_items": []', '"masked_items": [{"label": "otp"}]'), ('"turn_count": 1', '"turn_count": 2'), ('"safety_passed": true', '"safety_passed": 1'), ('"phase": "opening", ', ""),
    )
    lines = tuple(whole.replace(old, new.replace("\\\\", "\\")) if old else whole for old, new in edits)
    keys = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    return keys.select(F.col("c_custkey").alias("k"), F.parse_json(_said(lines, F.col("c_custkey"))).alias("raw"))


_CONTRACT_ERRORS = (
    None, "Missing record fields: ['channel']", "dialogue must be a non-empty list", "protected_assets must be a non-empty list", "risk_labels entries must be non-empty strings", "Invalid label: war", "Invalid split: all", "safety_masks must not expose original sensitive values",
    "gen_metadata must be an object", "turn_id mismatch at turn 1", "Unexpected speaker order at turn 1: victim", "dialogue[1].masked_items[0] is missing placeholder", "quality_checks.turn_count must match dialogue length", "quality_checks.safety_passed must be a boolean",
    "Missing turn fields at 1: ['phase']",
)


@registered("SELECT c_custkey AS k, [" + ", ".join("NULL" if e is None else "'" + e.replace("'", "''") + "'" for e in _CONTRACT_ERRORS) + f"][(c_custkey % {len(_CONTRACT_ERRORS)})::INT + 1] AS error FROM customer")
def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_lines(spark, sf_dir).select("k", validate.record_error().alias("error"))


@registered(f"SELECT count(*) FILTER (c_custkey % {len(_CONTRACT_ERRORS)} = 0) AS good, count(*) FILTER (c_custkey % {len(_CONTRACT_ERRORS)} <> 0) AS bad FROM customer")
def contract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.checked(contract_lines(spark, sf_dir)).agg(F.count_if(F.col("error").isNull()).alias("good"), F.count_if(F.col("error").isNotNull()).alias("bad"))


@registered("""SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 11 = 1 THEN 'invalid_event' END, CASE WHEN event_id % 11 = 2 THEN 'invalid_action' END, CASE WHEN event_id % 11 = 3 THEN 'invalid_policy_rule_ids' END,
  CASE WHEN event_id % 11 = 4 THEN 'invalid_evidence_turn_ids' WHEN event_id % 11 = 5 THEN 'out_of_window_evidence' END, CASE WHEN event_id % 11 = 6 THEN 'invalid_confidence' END, CASE WHEN event_id % 11 = 7 THEN 'unsafe_output:invented_url' END,
  CASE WHEN event_id % 11 = 8 THEN 'unsafe_output:invented_phone' END], lambda x: x IS NOT NULL), ',') AS errors FROM events""")
def prediction_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of which most have one fault: unknown values, evidence outside the window, unsafe text."""
    k = F.col("event_id")
    fault = lambda n, bad, good: F.when(k % 11 == n, bad).otherwise(good)
    key = F.concat(k.cast("string"), F.when(k % 11 == 7, " www.a").when(k % 11 == 8, " 010-1234-5678").otherwise(""))
    rows = table(spark, sf_dir, "events").select(
        "event_id", key.alias("benchmark_id"), fault(1, F.lit("some_event"), F.lit("new_sensitive_request")).alias("event"), fault(2, F.lit("shout"), F.lit("refuse_or_pause")).alias("action"),
        fault(3, F.array(F.lit("P_NO_SUCH")), F.array(F.lit("P_REFUSE"))).alias("policy_rule_ids"), fault(4, F.array().cast("array<int>"), fault(5, F.array(F.lit(9)), F.array(F.lit(1)))).alias("evidence_turn_ids"), fault(6, F.lit(1.5), F.lit(0.5)).alias("confidence"), F.array(F.lit(1), F.lit(2)).alias("ids"),
    )
    return rows.select("event_id", F.array_join(score.prediction_errors(F.col("ids")), ",").alias("errors"))


# Items.


@registered(_SPOKEN + f""", b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id),
i AS (SELECT u.*, bracket, list(phrase) OVER (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS shown FROM u JOIN b USING (stream_id)),
r AS (SELECT *, NOT bracket AND contains(array_to_string(shown, ' '), '[MASKED_MEMBER_STATUS]') AS risky FROM i)
SELECT 'public_item_count' AS metric, '' AS key, count(*) FILTER (NOT bracket AND NOT risky) AS n FROM r UNION ALL SELECT 'stream_count', '', count(DISTINCT stream_id) FILTER (NOT bracket AND NOT risky) FROM r
UNION ALL SELECT 'rejected_by_reason', 'stage_direction_or_unmasked_bracket', count(*) FROM b WHERE bracket UNION ALL SELECT 'rejected_by_reason', 'placeholder_reject_or_escalate', count(*) FROM r WHERE risky""")
def observed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stream.build_observed_items(_item_records(spark, sf_dir), {})
    return stream.yield_counts(items).where("metric IN ('public_item_count', 'stream_count', 'rejected_by_reason')")


def _item_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spoken_records(spark, sf_dir)
    turn = "transform(dialogue, t -> named_struct('turn_id', t.turn_id, 'speaker', t.speaker, 'utterance', t.utterance, 'stream_event', {e}, 'stream_action', {a}, 'stream_policy_rule_ids', array('P_MONITOR'), 'stream_evidence_turn_ids', array(greatest(t.turn_id - 1, 1))))"
    event = "if(t.turn_id % 4 = 0, '', if(t.turn_id % 2 = 0, 'needs_more_context', 'new_sensitive_request'))"
    more = {"prompt_version": F.lit("1"), "attacker_model": F.lit("m"), "victim_model": F.lit("m"), "fallback_turn_ids": F.array(F.lit(2)), "stream_profile": F.lit("p"), "trajectory_variant": F.lit("0"), "canonical_pair_index": F.lit(0)}
    meta = F.col("gen_metadata")
    for name, value in more.items():
        meta = meta.withField(name, value)
    return rows.withColumn("dialogue", F.expr(turn.format(e=event, a="if(t.turn_id % 2 = 0, 'monitor_only', 'refuse_or_pause')"))).withColumn("gen_metadata", meta).withColumn("split", F.lit("train"))


@registered(_SPOKEN + """, b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id)
SELECT stream_id AS source_id, turn_id AS stream_position, CASE WHEN turn_id % 2 = 0 THEN 'needs_more_context' ELSE 'new_sensitive_request' END AS event, turn_id = 2 AS fallback, greatest(turn_id - 1, 1)::INT AS evidence, least(turn_id, 6)::INT AS shown
FROM u JOIN b USING (stream_id) WHERE NOT bracket AND turn_id % 4 <> 0""")
def planned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of records that carry their plan: the gold and its manifest, joined to the public items."""
    items = stream.build_planned_items(_item_records(spark, sf_dir), {})
    if found := stream.forbidden_keys(items["public"]):
        raise ValueError(f"public items must not have {found}")
    public = items["public"].select("benchmark_id", F.size("input.dialogue_window").alias("shown"))
    rows = items["gold"].join(items["manifest"].select("benchmark_id", F.col("source.source_id").alias("source_id"), "stream_position"), "benchmark_id").join(public, "benchmark_id")
    return rows.select("source_id", "stream_position", "event", F.col("is_fallback_turn").alias("fallback"), F.get("evidence_turn_ids", 0).alias("evidence"), "shown")


@registered(_SPOKEN + """, b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id),
w AS (SELECT stream_id, turn_id, list(phrase) OVER (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS shown FROM u),
p AS (SELECT stream_id, turn_id, list_position(list_transform(shown, lambda s: contains(s, '알림 알림')), true) AS place, len(shown) AS n FROM w JOIN b USING (stream_id) WHERE NOT bracket AND turn_id % 4 <> 0)
SELECT (turn_id - n + place)::INT AS turn_id, '알림 알림' AS artifact, count(*) AS n FROM p WHERE place > 0 GROUP BY ALL""")
def repeated_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortcuts.repeated_nouns(stream.build_planned_items(_item_records(spark, sf_dir), {})["public"]).groupBy("turn_id", "artifact").agg(F.count("*").alias("n"))


# Files.


@registered("""SELECT 'read' AS step, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT 'appended', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'ids', count(*), sum(c_custkey)::BIGINT FROM customer UNION ALL SELECT 'bad', count(*), sum(r_regionkey)::BIGINT FROM region""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON lines: written, read again, appended to by id; and lines that are not JSON, put aside."""
    path = jsonl.scratch(spark, "lines")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("z"), F.col("c_acctbal").alias("a")).alias("more"))
    jsonl.write_records(rows.where("id % 3 <> 0"), f"{path}/records")
    total = lambda df, step, key="id": df.agg(F.lit(step).alias("step"), F.count("*").alias("n"), F.sum(F.col(key).cast("bigint")).alias("keys"))
    read = total(jsonl.read_records(spark, f"{path}/records", "id string, name string, more struct<z:bigint,a:double>"), "read")
    read = spark.createDataFrame(read.collect(), read.schema)  # one row: what follows adds files
    appended = total(jsonl.append_new(rows, f"{path}/records"), "appended")
    ids = total(jsonl.existing_ids(spark, f"{path}/records"), "ids")
    table(spark, sf_dir, "region").select(F.concat(F.col("r_regionkey").cast("string"), F.lit(" {no json")).alias("value")).unionByName(rows.select(F.to_json(F.struct("id")).alias("value"))).write.text(f"{path}/mixed")
    bad = total(jsonl.read_with_errors(spark, f"{path}/mixed")[1].select(F.regexp_extract("line", r"^(\d+)", 1).alias("id")), "bad")
    return read.unionByName(appended).unionByName(ids).unionByName(bad)


@registered(_SPOKEN + f"""SELECT stream_id, turn_id, CASE WHEN contains(phrase, '[한숨]') THEN 'x' ELSE '' END || CASE WHEN {_any('phrase', ('[MASKED_',))} THEN 'm' ELSE '' END AS shape FROM u""")
def utterance_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("phrase")
    return spoken(spark, sf_dir).select("stream_id", "turn_id", F.concat(F.when(text.has_unknown_bracket(p), "x").otherwise(""), F.when(text.has_placeholder(p), "m").otherwise("")).alias("shape"))


@registered("""SELECT asset, count(*) AS n FROM (SELECT unnest(CASE c_custkey % 3 WHEN 0 THEN ['account_password', 'otp_or_security_card', 'identity_document_image'] WHEN 1 THEN ['benefit_portal_credentials', 'identity_document_image', 'bank_account_for_disbursement', 'case_reference_number']
  ELSE ['identity_information', 'voice_sample'] END) AS asset FROM customer) GROUP BY asset""")
def scenario_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scenario = _said(("bank_fraud_alert", "public_benefit_notice", "no_such_notice"), F.col("c_custkey"))
    return table(spark, sf_dir, "customer").select(F.explode(schedule.default_assets(scenario)).alias("asset")).groupBy("asset").agg(F.count("*").alias("n"))


@registered(f"""SELECT c_custkey AS k, CASE WHEN c_nationkey = 3 AND c_custkey % 2 = 1 THEN 'a pair of their own' WHEN c_custkey % 4 = 0 THEN 'at the gate' ELSE '{schedule.OTHER_CONTEXT}' END AS context FROM customer""")
def persona_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), F.concat(F.lit("v"), F.col("c_nationkey").cast("string")).alias("victim_id"), F.concat(F.lit("a"), (k % 2).cast("string")).alias("attacker_id"), F.concat(F.lit("s"), (k % 4).cast("string")).alias("scenario_type"))
    pairs = spark.createDataFrame([("v3", "a1", "a pair of their own"), ("v4", "a1", "")], "victim_id string, attacker_id string, context string")
    scenarios = spark.createDataFrame([("s0", "at the gate")], "scenario_type string, context string")
    return schedule.with_context(rows, pairs, scenarios).select("k", "context")


@registered(_SPOKEN + f""", f AS (SELECT *, regexp_extract_all(phrase, '{_MASK}') AS found, regexp_replace(phrase, '{_MASK}', ' ', 'g') AS bare FROM u)
SELECT stream_id, turn_id, (turn_id % 2 = 0 OR len(found) = 0) AND NOT contains(phrase, '[한숨]') AND len(regexp_extract_all(bare, '[가-힣]')) >= 9 AND NOT {_any('phrase', K.SHORT_UTTERANCES)} AND NOT {_any('phrase', K.RESIDUE_MARKERS)} AS valid FROM f""")
def valid_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an utterance fits the placeholders that every second turn is to have."""
    p = F.col("phrase")
    required = F.when(F.col("turn_id") % 2 == 0, text.placeholders(p)).otherwise(F.array().cast("array<string>"))
    return spoken(spark, sf_dir).select("stream_id", "turn_id", gates.valid_utterance(p, required).alias("valid"))


@registered(_RECORDS + f""", g AS (SELECT *, {_list(K.PROFILES)}[(k % 5)::INT + 1] AS profile, array_to_string(said, '|') AS whole FROM q)
SELECT id, len(list_distinct(said)) = len(said) AS duplicate_turns_clean, profile <> 'benign_thin_context' OR NOT {_any('whole', ('[MASKED_', *gates.STRONG_RESPONSE))} AS benign_thin_context_valid,
  NOT list_contains(list_transform(said, lambda s, i: i % 4 = 2 AND {_any('s', gates.REQUEST_VOICE)}), true) AS speaker_perspective_valid FROM g""")
def stream_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of records in which every fourth turn, from the second on, is to be a disclosure."""
    dialogue = F.expr("transform(dialogue, t -> named_struct('turn_id', t.turn_id, 'speaker', t.speaker, 'utterance', t.utterance, 'stream_event', if(t.turn_id % 4 = 2, 'recipient_partial_or_direct_disclosure', 'needs_more_context')))")
    flags = gates.stream_flags(F.col("dialogue"), _said(K.PROFILES, F.col("id").cast("bigint")))
    return spoken_records(spark, sf_dir).withColumn("dialogue", dialogue).select("id", *(flags[c].alias(c) for c in ("duplicate_turns_clean", "benign_thin_context_valid", "speaker_perspective_valid")))


@registered("""SELECT count(*) AS records, 2 * count(*) FILTER (c_custkey % 2 = 0) AS fallback_turns, count(*) FILTER (c_custkey % 3 <> 0) AS semantic_repair_turns, count(*) FILTER (c_custkey % 4 = 0) AS schema_valid, count(*) FILTER (c_custkey % 5 <> 0) AS safety_passed FROM customer""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, ids = F.col("c_custkey"), lambda *v: F.array(*map(F.lit, v)).cast("array<int>")
    meta = F.struct(F.when(k % 2 == 0, ids(1, 2)).alias("fallback_turn_ids"), F.when(k % 3 == 0, ids()).otherwise(ids(4)).alias("semantic_repair_turn_ids"))
    checks = F.struct((k % 4 == 0).alias("schema_valid"), (k % 5 != 0).alias("safety_passed"))
    return quality.run_summary(table(spark, sf_dir, "customer").select(meta.alias("gen_metadata"), checks.alias("quality_checks")), ("schema_valid", "safety_passed"))


@registered("SELECT count(*) AS lines, sum(c_custkey + 1)::BIGINT AS numbers FROM customer WHERE c_custkey % 7 = 3")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh line of a file is no JSON; the sum of their numbers, which the key and one are."""
    path = jsonl.scratch(spark, "lines")
    rows = table(spark, sf_dir, "customer")
    told = F.when(F.col("c_custkey") % 7 == 3, F.concat(F.lit("{"), F.col("c_custkey").cast("string"))).otherwise(F.to_json(F.struct("c_custkey")))
    rows.orderBy("c_custkey").select(told.alias("value")).coalesce(1).write.text(path)
    return jsonl.malformed(spark, path).agg(F.count("*").alias("lines"), F.sum("number").alias("numbers"))


@registered(_SPOKEN + """, b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id)
SELECT 3 AS fixtures, true AS whole FROM (SELECT count(*) AS n FROM u JOIN b USING (stream_id) WHERE NOT bracket) WHERE n >= 3""")
def sample_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: three items, each with its manifest and gold."""
    found = jsonl.sample_fixtures(stream.build_planned_items(_item_records(spark, sf_dir), {}))
    same = lambda name: F.get_json_object(name, "$.benchmark_id") == F.col("benchmark_id")
    return found.agg(F.count("*").cast("int").alias("fixtures"), F.min(same("public") & same("manifest") & same("gold")).alias("whole"))


_KEPT = ", b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id), i AS (SELECT u.* FROM u JOIN b USING (stream_id) WHERE NOT bracket AND turn_id % 4 <> 0)"


@registered(_SPOKEN.rstrip() + _KEPT + rf"""
SELECT turn_id AS position, turn_id = 2 AS fallback, array_to_string(list_sort(list_distinct(regexp_extract_all(phrase, '\[MASKED_([A-Z0-9_]+)\]', 1))), ',') AS types, {_names('phrase', shortcuts.ACTION_CUES, False)} AS cues, least(length(phrase) // 18, 5)::INT AS length, count(*) AS n
FROM i GROUP BY ALL""")
def surface_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with what their manifest and public item add: what a turn looks like from outside."""
    items = stream.build_planned_items(_item_records(spark, sf_dir), {})
    rows = shortcuts.joined(items["public"], items["manifest"], items["gold"])
    shape = [F.array_join("surface_feature.own_types", ",").alias("types"), F.array_join("action_feature.cues", ",").alias("cues"), F.col("surface_feature.length").alias("length")]
    return rows.groupBy("position", "fallback", *shape).agg(F.count("*").alias("n"))


@registered(_SPOKEN.rstrip() + _KEPT + """, p AS (SELECT run, turn_id % 2 = 1 AS due, CASE run WHEN 'always_active' THEN true WHEN 'static_verify' THEN true WHEN 'never_active' THEN false WHEN 'caller_turn_only' THEN speaker = 'attacker' WHEN 'position_only' THEN turn_id >= 3 ELSE least(turn_id, 6) >= 4 END AS came
  FROM i, (SELECT unnest(['always_active', 'static_verify', 'never_active', 'caller_turn_only', 'position_only', 'window_length_only']) AS run))
SELECT run, count(*) FILTER (due AND NOT came) AS missed, count(*) FILTER (due) AS actionable, count(*) FILTER (came AND NOT due) AS false_active, count(*) FILTER (NOT due) AS inactive FROM p GROUP BY run""")
def baseline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trivial baselines that don't read the words, scored on planned items."""
    items = stream.build_planned_items(_item_records(spark, sf_dir), {})
    found = score.score_baselines(items["public"], items["gold"]).where(F.col("run").isin("always_active", "static_verify", "never_active", "caller_turn_only", "position_only", "window_length_only"))
    return found.select("run", "missed", "actionable", "false_active", "inactive")


@registered(r"""SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey AS k, 'a "b", {c} [' || c_name || '] \, ' AS name, c_nationkey || '/' || c_custkey % 3 AS more FROM customer""")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as one JSON array in a file, with commas, brackets and quotes in strings, and its entries again with their places."""
    path = jsonl.scratch(spark, "array")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit('a "b", {c} ['), "c_name", F.lit("] \\, ")).alias("name"), F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey") % 3).alias("more"))
    low, high = rows.agg(F.min("k"), F.max("k")).first()
    line = F.concat(F.when(F.col("k") == low, "[").otherwise(" "), F.to_json(F.struct("*")), F.when(F.col("k") == high, "]").otherwise(","))
    rows.orderBy("k").select(line.alias("value")).coalesce(1).write.text(path)
    found = jsonl.read_array(spark, path, "k: bigint, name: string, more: array<bigint>")
    return found.select("pos", "k", "name", F.array_join(F.transform("more", lambda x: x.cast("string")), "/").alias("more"))


#: Items with a name in an object, below arrays, beside a text that looks like it, and only in texts; and the paths there.
_ITEMS = ({"input": {"a": {"@": 1}}}, {"input": [{"x": [[3, {"@": {"y": 2}}]]}]}, {"@": None, "s": '"@": 1'}, {"s": '{"@": 1}', "names": ["@"]})
_PATHS = ("$.input.a.", "$.input[0].x[0][1].", "$.", "")


@registered(f"""WITH k AS (SELECT c_custkey AS k, {_list(K.FORBIDDEN_PUBLIC_KEYS)}[(c_custkey % {len(K.FORBIDDEN_PUBLIC_KEYS)})::INT + 1] AS name, {_list(_PATHS)}[((c_custkey // 5) % 4)::INT + 1] AS place FROM customer)
SELECT k, name, place || name AS path FROM k WHERE place <> ''""")
def forbidden_key_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where in raw items the names are that a public item must not have: in objects, maps and arrays of any depth."""
    k = F.col("c_custkey")
    item = F.replace(_said(tuple(json.dumps(i) for i in _ITEMS), F.floor(k / 5)), F.lit("@"), _said(K.FORBIDDEN_PUBLIC_KEYS, k))
    return validate.forbidden_paths(table(spark, sf_dir, "customer").select(k.alias("k"), F.parse_json(item).alias("raw")), "k")
