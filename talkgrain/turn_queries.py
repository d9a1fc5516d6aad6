"""Queries of what turns do one after another, over conversations of phrases: transitions, labels, outcomes, masks, gates and placeholders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import gates, labels, masking, text
from talkgrain.operators import quality, records, score, shortcuts, stream
from talkgrain.queries import _EVENTS, event_items, registered
from talkgrain.rule_queries import _HAS, _MASK, _RECORDS, _REFUSES, _RULES, _SPOKEN, _any, _item_records, _list, _names, _re, _said, spoken, spoken_records
from talkgrain.sources import jsonl
from talkgrain.streaming import transitions as online


def _found(c: str, lexicon: dict) -> str:
    return "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_any(c, words)} THEN '{name}' END" for name, words in lexicon.items()) + "], lambda x: x IS NOT NULL))"


def _transitions(c: str, rows: str) -> str:
    """Common table expressions that end in ``x``: the turns of ``rows`` with their events, by lists of names."""
    return f"""f AS (SELECT *, CASE WHEN speaker = 'attacker' THEN {_found(c, K.REQUEST_KEYWORDS)} ELSE [] END AS req, CASE WHEN speaker = 'attacker' THEN {_found(c, K.PRESSURE_KEYWORDS)} ELSE [] END AS pre, {_any(c, K.PATH_TERMS)} AS path,
  contains({c}, '공식') AND {_any(c, ('후', '확인'))} AS official, {_HAS(c)} AND {_any(c, K.DISCLOSURE_VERBS)} AS gives FROM {rows}),
g AS (SELECT *, speaker = 'victim' AND NOT (gives AND official) AND (gives OR (NOT ({_HAS(c)} AND {_any(c, ('맞나요', '확인'))}) AND contains({c}, '[MASKED_') AND NOT official AND {_any(c, K.STREAM_DISCLOSURE_VERBS)})) AS direct,
  speaker = 'victim' AND NOT gives AND NOT {_any(c, K.UNCERTAINTY_KEYWORDS)} AND ({_any(c, (*K.REFUSAL_KEYWORDS, '직접'))} OR (contains({c}, '공식') AND contains({c}, '확인'))) AS safe FROM f),
h AS (SELECT *, COALESCE(flatten(list(req) OVER b), []) AS req0, COALESCE(flatten(list(pre) OVER b), []) AS pre0, COALESCE(list(turn_id) FILTER (direct) OVER b, []) AS told FROM g
  WINDOW b AS (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, speaker = 'attacker' AS caller, list_contains(req0, '{K.PATH_REQUEST}') AS path0, len(list_filter(req, lambda x: NOT list_contains(req0, x))) > 0 AS more, len(list_filter(pre, lambda x: NOT list_contains(pre0, x))) > 0 AS harder FROM h),
j AS (SELECT *, CASE WHEN direct THEN 'recipient_partial_or_direct_disclosure' WHEN len(told) > 0 THEN 'recovery_followup_due' WHEN caller AND (path OR list_contains(req, '{K.PATH_REQUEST}')) AND NOT path0 THEN 'new_caller_directed_path'
  WHEN caller AND more THEN 'new_sensitive_request' WHEN caller AND harder AND len(req0) + len(req) > 0 THEN 'pressure_escalation' WHEN safe THEN 'recipient_containment' WHEN caller AND len(pre) > 0 AND len(req) + len(req0) = 0 THEN 'pressure_only_monitor'
  WHEN len(req0) + len(req) + len(pre0) + len(pre) = 0 THEN 'needs_more_context' ELSE 'no_new_actionable_event' END AS event FROM i),
x AS (SELECT *, CASE event WHEN 'no_new_actionable_event' THEN 'no_alert' WHEN 'recipient_containment' THEN 'no_alert' WHEN 'needs_more_context' THEN 'monitor_only' WHEN 'pressure_only_monitor' THEN 'monitor_only' WHEN 'pressure_escalation' THEN 'pause_or_verify'
  WHEN 'new_sensitive_request' THEN 'refuse_or_pause' WHEN 'new_caller_directed_path' THEN 'refuse_or_pause' ELSE 'preserve_and_report' END AS action, CASE event WHEN 'recovery_followup_due' THEN told[-1] ELSE turn_id END AS evidence FROM j)"""


_TRANSITIONS = _SPOKEN.rstrip() + ", " + _transitions("utterance", "u")


@registered(_TRANSITIONS + """ SELECT stream_id, turn_id, event, action, evidence, array_to_string(list_sort(list_distinct(req0)), ',') AS requested, array_to_string(list_sort(list_distinct(pre0)), ',') AS pressed, array_to_string(told, ',') AS disclosed FROM x""")
def transition_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each turn of the conversations is, by what was asked for, pressed for and disclosed before it."""
    rows = stream.transitions(spoken(spark, sf_dir))
    joined = lambda c: F.array_join(F.col(f"oracle_state.{c}").cast("array<string>"), ",")
    return rows.select(
        "stream_id", "turn_id", "event", "action", F.get("evidence_turn_ids", 0).alias("evidence"), joined("prior_request_types").alias("requested"), joined("prior_pressure_categories").alias("pressed"),
        joined("prior_direct_disclosure_turn_ids").alias("disclosed"),
    )


#: In how many batches the turns of a stream arrive at most.
ARRIVALS = 4


def timed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same turns with the time at which each was said: ten seconds a turn."""
    rows = spoken(spark, sf_dir)
    return rows.select("stream_id", F.col("turn_id").cast("bigint").alias("turn_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("turn_id") * 10).alias("at"), "speaker", "utterance")


@registered(_TRANSITIONS + " SELECT stream_id, turn_id::BIGINT AS turn_id, event, action, evidence::BIGINT AS evidence FROM x")
def transition_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stateful stream in a few runs on one checkpoint: each turn arrives up to thirty seconds late, behind later ones."""
    run = jsonl.scratch(spark, "turns")
    rows = timed_turns(spark, sf_dir)
    arrives = F.unix_timestamp("at") + F.pmod(F.xxhash64("stream_id", "turn_id"), F.lit(30))
    # What arrives in one of a few spans of time, however long the conversations are, is one batch, of any number of files; a tick moves the watermark past all.
    low, high = (k or 0 for k in rows.select(arrives.alias("s")).agg(F.min("s"), F.max("s")).first())
    span = max(20, -(-(high - low + 1) // ARRIVALS))
    rows.withColumn("_batch", F.floor((arrives - low) / span).cast("int")).write.partitionBy("_batch").parquet(f"{run}/arrivals")
    arrivals = spark.read.schema(f"{online.TURNS}, _batch int").parquet(f"{run}/arrivals")
    batches = [arrivals.where(F.col("_batch") == k).drop("_batch") for k in range((high - low) // span + 1)]
    for batch in [*batches, online.tick(spark, "2100-01-01 00:00:00").coalesce(1)]:
        batch.write.mode("append").parquet(f"{run}/in")
        online.run_available(spark.readStream.schema(online.TURNS).parquet(f"{run}/in"), f"{run}/state", f"{run}/out", "30 seconds")
    return spark.read.parquet(f"{run}/out").select("stream_id", "turn_id", "event", "action", F.get("evidence_turn_ids", 0).alias("evidence"))


@registered(_SPOKEN.rstrip() + ", b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id), k AS (SELECT u.* FROM u JOIN b USING (stream_id) WHERE NOT bracket), " + _transitions("phrase", "k") + f""",
r AS (SELECT *, contains(array_to_string(list(phrase) OVER (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), ' '), '[MASKED_MEMBER_STATUS]') AS risky FROM x),
n AS (SELECT * FROM r WHERE NOT risky), m AS (SELECT 'event_distribution' AS metric, v.key, count(n.event) AS n FROM (SELECT unnest({_list(K.EVENTS)}) AS key) v LEFT JOIN n ON n.event = v.key GROUP BY v.key
  UNION ALL SELECT 'action_distribution', v.key, count(n.action) FROM (SELECT unnest({_list(K.ACTIONS)}) AS key) v LEFT JOIN n ON n.action = v.key GROUP BY v.key)
SELECT * FROM m UNION ALL SELECT 'gold_status_distribution', 'diagnostic_only', count(*) FROM n UNION ALL SELECT 'surface_distribution', 'typed_raw', count(*) FROM n UNION ALL SELECT 'placeholder_status_distribution', 'programmatic_validated', count(*) FROM n
UNION ALL SELECT 'rejected_count', '', (SELECT count(*) FROM b WHERE bracket) + (SELECT count(*) FROM r WHERE risky)""")
def observed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gold of items says that comes from what their turns do, and what the yield report says of it."""
    items = stream.build_observed_items(_item_records(spark, sf_dir), {})
    metrics = ("event_distribution", "action_distribution", "gold_status_distribution", "surface_distribution", "placeholder_status_distribution", "rejected_count")
    return stream.yield_counts(items).where(F.col("metric").isin(*metrics))


_ONLY_REFUSES = f"partial AND len(about) > 0 AND len(list_filter(about, lambda c: NOT {_REFUSES('c')})) = 0"
_COMPROMISE = "NOT conditional AND (open OR yields)"
_RISK = " ".join(f"WHEN {_any('lower(utterance)', words)} THEN ['{K.RISK_INTENTS[risk]}', '{risk}']" for risk, words in K.RISK_KEYWORDS.items())


@registered(_RULES + f""", a AS (SELECT *, CASE WHEN speaker <> 'victim' THEN CASE {_RISK} ELSE ['social_engineering_probe', 'other'] END WHEN {_ONLY_REFUSES} THEN ['resist_or_verify_request', 'victim_resistance']
  WHEN partial AND open AND NOT conditional THEN ['disclose_or_comply', 'asset_disclosure'] WHEN partial THEN ['uncertain_response', 'victim_uncertainty'] WHEN {_any('lower(utterance)', K.COMPROMISE_KEYWORDS)} AND {_COMPROMISE} THEN ['disclose_or_comply', 'asset_disclosure']
  WHEN {_REFUSES('utterance')} OR {_any('utterance', K.DEFENSE_KEYWORDS)} THEN ['resist_or_verify_request', 'victim_resistance'] ELSE ['uncertain_response', 'victim_uncertainty'] END AS a FROM r)
SELECT stream_id, turn_id, a[1] AS intent_label, a[2] AS risk_signal FROM a""")
def label_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spoken(spark, sf_dir).select("stream_id", "turn_id", labels.annotate_turn(F.col("speaker"), F.col("utterance"), F.lit("other")).alias("a"))
    return rows.select("stream_id", "turn_id", "a.*")


_GIVES_UP = (*K.COMPLIANCE_KEYWORDS, *K.COMPROMISE_KEYWORDS)
_GIVEN = ", ".join(f"CASE WHEN contains(phrase, '{p}') AND len(list_filter(clauses, lambda c: contains(c, '{p}') AND NOT {_REFUSES('c')} AND {_any('lower(c)', _GIVES_UP)})) > 0 THEN 'masked_{label}' END" for label, p, _ in K.MASKS)


@registered(_RULES + f""", v AS (SELECT *, {_ONLY_REFUSES} AS declines, {_COMPROMISE} AS falls, {_REFUSES('utterance')} OR {_any('utterance', K.OUTCOME_DEFENSE_KEYWORDS)} AS defends, list_filter([{_GIVEN}], lambda x: x IS NOT NULL) AS given FROM r WHERE speaker = 'victim'),
o AS (SELECT stream_id, CASE WHEN bool_or(partial AND NOT declines AND NOT conditional AND open) THEN 'compromised' WHEN bool_or(partial AND NOT declines) THEN 'inconclusive' WHEN bool_or(falls) THEN 'compromised' WHEN bool_or(defends) THEN 'defended_success' ELSE 'inconclusive' END AS outcome,
  list_sort(list_distinct(COALESCE(flatten(list(given) FILTER (falls)), []))) AS assets, bool_or(falls) AS fell FROM v GROUP BY stream_id)
SELECT DISTINCT u.stream_id, COALESCE(outcome, 'inconclusive') AS outcome, CASE WHEN outcome = 'compromised' THEN CASE WHEN len(assets) > 0 THEN array_to_string(assets, ',') WHEN fell THEN 'unknown_masked_asset' ELSE '' END ELSE '' END AS assets FROM u LEFT JOIN o USING (stream_id)""")
def outcome_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for label, placeholder, _ in K.MASKS for x in (placeholder, label)])
    items = F.transform(F.filter(text.placeholders(F.col("phrase")), lambda p: p.isin(*K.STANDARD_PLACEHOLDERS)), lambda p: F.struct(F.element_at(known, p).alias("label"), p.alias("placeholder")))
    turn = F.struct("turn_id", "speaker", "utterance", items.alias("masked_items"))
    rows = spoken(spark, sf_dir).groupBy("stream_id").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"))
    return rows.select("stream_id", records.outcome(F.col("dialogue")).alias("outcome"), F.array_join(records.compromised_assets(F.col("dialogue")), ",").alias("assets"))


@registered(_SPOKEN + f"SELECT stream_id, turn_id, {_names('phrase', K.REQUEST_KEYWORDS)} AS requests, {_names('phrase', K.PRESSURE_KEYWORDS)} AS pressures FROM u")
def request_and_pressure_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("phrase")
    return spoken(spark, sf_dir).select("stream_id", "turn_id", F.array_join(labels.requests(c), ",").alias("requests"), F.array_join(labels.pressure_categories(c), ",").alias("pressures"))


#: What stands before a phrase, what masking makes of it, and the labels of what it masks.
MASKED = (
    ("otp 123456, https://a.example/x 010-1234-5678", "[MASKED_OTP], [MASKED_URL] [MASKED_PHONE]", "url,otp,phone"), ("900101-1234567 a.b@c.example password: abcd1234", "[MASKED_RRN] [MASKED_EMAIL] [MASKED_CREDENTIAL]", "rrn,email,credential"),
    ("123-456-789012 [MASKED_CASE_ID] [caller_name]", "[MASKED_ACCOUNT] [MASKED_CASE_REFERENCE] [MASKED_NAME]", "account"), ("2026-06-02 번호010-1234-5678", "2026-06-02 번호010-1234-5678", ""),
    ("[otp] [school_office] [MASKED_TEAM_LEAD] [MASKED_NAME]", "[MASKED_CASE_REFERENCE] [MASKED_COMPANY] [MASKED_COMPANY] [MASKED_NAME]", ""), ("pineapple", "[MASKED_CREDENTIAL]", "credential"), ("", "", ""),
    ("[MASKED_ID_NUMBER_2] [MASKED_HOME_ADDRESS]", "[MASKED_CASE_REFERENCE] [MASKED_HOME_ADDRESS]", ""),
)


def _pick(place: int) -> str:
    return f"{_list(m[place] for m in MASKED)}[((stream_id::BIGINT + turn_id) % {len(MASKED)})::INT + 1]"


@registered(_SPOKEN.rstrip() + f""", k AS (SELECT *, {_pick(1)} || ' ' || phrase AS masked, {_pick(2)} AS more, list_transform(list_filter(regexp_extract_all(phrase, '{_MASK}'), lambda p: list_contains({_list(K.STANDARD_PLACEHOLDERS)}, p)), lambda p: lower(p[9:-2])) AS there FROM u)
SELECT stream_id, turn_id, masked, array_to_string(list_filter(list_concat(there, string_split(more, ',')), lambda x: x <> ''), ',') AS labels FROM k""")
def mask_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.concat(_said(tuple(m[0] for m in MASKED), F.col("stream_id").cast("bigint") + F.col("turn_id")), F.lit(" "), F.col("phrase"))
    rows = spoken(spark, sf_dir).select("stream_id", "turn_id", masking.mask_text(given).alias("m"))
    return rows.select("stream_id", "turn_id", F.col("m.text").alias("masked"), F.array_join(F.transform("m.masked_items", lambda i: i["label"]), ",").alias("labels"))


def gated(rows: DataFrame) -> DataFrame:
    """Turns with an event, a profile and the placeholders of a plan; every fifth plan has none."""
    k = F.col("stream_id").cast("bigint")
    planned = F.when(F.col("turn_id") % 5 == 0, F.array().cast("array<string>")).otherwise(text.placeholders(F.col("phrase")))
    return rows.select("*", planned.alias("planned"), _said(K.EVENTS, k + F.col("turn_id") * 4).alias("event"), _said(K.PROFILES, F.floor(k / 3)).alias("profile"))


_PRESSES, _OK = _any("phrase", gates.PRESSURE), "len(found) > 0"
_GATED = _SPOKEN.rstrip() + f""", p AS (SELECT *, list_sort(regexp_extract_all(phrase, '{_MASK}')) AS found, {_list(K.EVENTS)}[((stream_id::BIGINT + turn_id * 4) % {len(K.EVENTS)})::INT + 1] AS event, {_list(K.PROFILES)}[((stream_id::BIGINT // 3) % 5)::INT + 1] AS profile FROM u),
q AS (SELECT *, CASE WHEN turn_id % 5 = 0 THEN [] ELSE found END AS planned, contains(phrase, '[MASKED_') AND {_any('phrase', gates.DISCLOSURE_VERBS)} AS discloses, speaker = 'attacker' AS caller, speaker = 'victim' AS recipient FROM p),
e AS (SELECT *, CASE WHEN profile = 'benign_thin_context' AND {_OK} THEN 'benign_thin_context_must_not_use_sensitive_placeholder' WHEN profile = 'benign_thin_context' AND {_any('phrase', gates.STRONG_RESPONSE)} THEN 'benign_thin_context_uses_overstrong_response_language'
  WHEN event = 'needs_more_context' THEN CASE WHEN {_OK} THEN 'needs_more_context_must_not_use_sensitive_placeholder' END
  WHEN event = 'pressure_only_monitor' THEN CASE WHEN {_OK} THEN 'pressure_only_monitor_must_not_use_sensitive_placeholder' WHEN NOT {_PRESSES} THEN 'pressure_only_monitor_needs_pressure_signal' END
  WHEN event = 'new_sensitive_request' THEN CASE WHEN NOT caller THEN 'new_sensitive_request_must_be_attacker' WHEN len(found) = 0 THEN 'new_sensitive_request_missing_placeholder' WHEN NOT {_any('phrase', gates.REQUEST_WORDS)} THEN 'new_sensitive_request_missing_request_language' END
  WHEN event = 'new_caller_directed_path' THEN CASE WHEN NOT caller THEN 'new_caller_directed_path_must_be_attacker' WHEN NOT list_contains(found, '[MASKED_URL]') THEN 'new_caller_directed_path_missing_masked_url'
    WHEN NOT {_any(f"regexp_replace(phrase, '{_MASK}', ' ', 'g')", gates.PATH_WORDS)} THEN 'new_caller_directed_path_missing_path_language' END
  WHEN event = 'pressure_escalation' THEN CASE WHEN NOT caller THEN 'pressure_escalation_must_be_attacker' WHEN {_OK} THEN 'pressure_escalation_must_not_add_placeholder' WHEN NOT {_PRESSES} THEN 'pressure_escalation_missing_pressure_signal' END
  WHEN event = 'recipient_containment' THEN CASE WHEN NOT recipient THEN 'recipient_containment_must_be_victim' WHEN discloses AND NOT {_any('phrase', gates.REFUSALS)} THEN 'recipient_containment_contains_direct_disclosure' WHEN NOT {_any('phrase', gates.CONTAINMENT)} THEN 'recipient_containment_missing_safe_path_or_refusal' END
  WHEN event = 'recipient_partial_or_direct_disclosure' THEN CASE WHEN NOT recipient THEN 'recipient_disclosure_must_be_victim' WHEN len(found) = 0 THEN 'recipient_disclosure_missing_placeholder' WHEN NOT discloses THEN 'recipient_disclosure_missing_first_person_disclosure_verb'
    WHEN {_any('phrase', gates.REQUEST_VOICE)} THEN 'recipient_disclosure_uses_caller_request_voice' WHEN {_any('phrase', gates.NO_DISCLOSURE_WORDS)} THEN 'recipient_disclosure_contains_recovery_or_refusal_language' END
  WHEN event = 'recovery_followup_due' THEN CASE WHEN recipient AND {_OK} THEN 'victim_recovery_followup_must_not_add_placeholder' WHEN recipient AND NOT {_any('phrase', gates.RECOVERY_WORDS)} THEN 'victim_recovery_followup_missing_recovery_language'
    WHEN caller AND len(planned) > 0 AND NOT {_any('phrase', gates.CONTINUATION_WORDS)} THEN 'caller_recovery_followup_missing_continuation_language' END
  WHEN recipient AND discloses THEN 'victim_direct_disclosure_on_non_disclosure_event' END AS broken,
  CASE WHEN {_any('phrase', K.SHORT_UTTERANCES)} OR len(regexp_extract_all(regexp_replace(phrase, '{_MASK}', ' ', 'g'), '[가-힣]')) < 9 THEN 'very_short_utterance' END AS artifact FROM q)
"""


@registered(_GATED + "SELECT stream_id, turn_id, CASE WHEN found <> planned THEN 'semantic_placeholder_mismatch' ELSE COALESCE(artifact, broken) END AS error FROM e")
def semantic_gate_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gated(spoken(spark, sf_dir))
    return rows.select("stream_id", "turn_id", gates.semantic_error(*(F.col(c) for c in ("phrase", "planned", "event", "speaker", "profile"))).alias("error"))


@registered(_GATED + """SELECT stream_id, bool_and(artifact IS NULL AND broken IS NULL) AS stream_semantic_valid, any_value(profile) <> 'partial_disclosure_recovery' OR
  (count(*) FILTER (event = 'recipient_partial_or_direct_disclosure') > 0 AND count(*) FILTER (event = 'recipient_partial_or_direct_disclosure' AND (artifact IS NOT NULL OR broken IS NOT NULL)) = 0) AS partial_disclosure_semantic_valid FROM e GROUP BY stream_id""")
def semantic_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two flags of a record that look at what its turns should do."""
    turn = F.struct("turn_id", "speaker", F.col("phrase").alias("utterance"), F.col("event").alias("stream_event"))
    rows = gated(spoken(spark, sf_dir)).groupBy("stream_id").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"), F.first("profile").alias("profile"))
    flags = gates.stream_flags(F.col("dialogue"), F.col("profile"))
    return rows.select("stream_id", *(flags[c].alias(c) for c in ("stream_semantic_valid", "partial_disclosure_semantic_valid")))


#: Placeholders beside the phrases' own, and what is to become of each.
PLACEHOLDERS = (
    ("[MASKED_NAME]", "allowlist_candidate", "allowlist"), ("[MASKED_VOICE_SAMPLE]", "allowlist_candidate", "reviewed_sensitive"), ("[MASKED_COMPANY_EMAIL]", "normalize_to_existing", "normalize"),
    ("[MASKED_PORTAL_LINK]", "normalize_to_existing", "normalize"), ("[MASKED_MEMBER_STATUS]", "unclassified_review_required", "reviewed_sensitive"), ("[MASKED_SOMETHING]", "unclassified_review_required", "reject_or_escalate"),
    ("[MASKED_JOB_TITLE]", "warning_keep_unstandardized", "reject_or_escalate"), ("[MASKED_ID_NUMBER]", "normalize_to_existing", "normalize"),
)


@registered(_SPOKEN.rstrip() + f""", k AS (SELECT unnest(list_append(regexp_extract_all(phrase, '{_MASK}'), {_list(p for p, _, _ in PLACEHOLDERS)}[((stream_id::BIGINT * 3 + turn_id) % {len(PLACEHOLDERS)})::INT + 1])) AS placeholder FROM u)
SELECT placeholder, n, decision, bucket FROM (SELECT placeholder, count(*) AS n FROM k WHERE NOT list_contains({_list(K.STANDARD_PLACEHOLDERS)}, placeholder) GROUP BY placeholder)
JOIN (VALUES {', '.join(map(str, PLACEHOLDERS))}) v(placeholder, decision, bucket) USING (placeholder)""")
def placeholder_policy_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = _said(tuple(p for p, _, _ in PLACEHOLDERS), F.col("stream_id").cast("bigint") * 3 + F.col("turn_id"))
    turns = spoken(spark, sf_dir).select(F.concat("phrase", F.lit(" "), more).alias("utterance"))
    return quality.placeholder_policy(quality.unknown_placeholder_counts(turns)).select("placeholder", "n", "decision", "bucket")


def _corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, their turns in order, and the usual risks of two scenarios."""
    rows = spoken_records(spark, sf_dir)
    told = records.turns(rows.select(F.col("id").alias("record_id"), "dialogue")).withColumn("ord", F.struct(F.col("record_id").cast("bigint"), "place"))
    defaults = spark.createDataFrame([("scenario-0", ["urgency", "authority_impersonation"]), ("scenario-1", ["urgency"])], "scenario_type string, risks array<string>")
    return rows, told, defaults


_CUE_LIST = "list_filter([" + ", ".join(f"CASE WHEN {_re('{c}', p)} THEN '{n}' END" for n, p in K.PRESSURE_CUES.items()).replace("{c}", "@") + "], lambda c: c IS NOT NULL)"
_LONG = _RECORDS.rstrip() + f""", d AS (SELECT *, CASE scenario_type WHEN 'scenario-0' THEN ['authority_impersonation', 'urgency'] WHEN 'scenario-1' THEN ['urgency'] ELSE ['voice_impersonation'] END AS usual, {_CUE_LIST.replace('@', "array_to_string(list_filter(said, lambda s, i: i % 2 = 1), ' ')")} AS cues,
  CASE WHEN target = 'masked_compromise' THEN outcome = 'compromised' ELSE outcome = target END AS matches, len(said) AS n_turns FROM q),
w AS (SELECT u.*, {_CUE_LIST.replace('@', 'phrase')} AS cues, regexp_extract_all(phrase, '{_MASK}') AS found FROM u),
l AS (SELECT 'corpus' AS section, 'records' AS key, 1 AS n FROM d UNION ALL SELECT 'corpus', 'turns', n_turns FROM d UNION ALL SELECT 'corpus', 'not_attacks', 1 FROM d WHERE label <> 'attack' UNION ALL SELECT 'label', label, 1 FROM d UNION ALL SELECT 'outcome', outcome, 1 FROM d
  UNION ALL SELECT 'scenario', scenario_type, 1 FROM d UNION ALL SELECT 'victim', 'v' || k % 5, 1 FROM d UNION ALL SELECT 'attacker', 'a' || k % 3, 1 FROM d UNION ALL SELECT 'risk', 'records', 1 FROM d UNION ALL SELECT 'risk', 'mismatches', 1 FROM d WHERE usual <> seen
  UNION ALL SELECT 'risk', 'without_risk', 1 FROM d WHERE len(seen) = 0 UNION ALL SELECT 'id', '', 1 FROM d UNION ALL SELECT 'context ' || f, CASE WHEN k % (j + 3) = 0 THEN '' ELSE f || '-' || k % (j + 2) END, 1 FROM d, (SELECT unnest({_list(K.CONTEXT_FIELDS)}) AS f, unnest(range({len(K.CONTEXT_FIELDS)})) AS j)
  UNION ALL SELECT 'style', 'assigned', 1 FROM d WHERE style IS NOT NULL UNION ALL SELECT 'style', 'matches', 1 FROM d WHERE list_contains(cues, style) UNION ALL SELECT 'style', 'urgency_leaks', 1 FROM d WHERE style <> 'urgency' AND list_contains(cues, 'urgency')
  UNION ALL SELECT 'target', 'assigned', 1 FROM d WHERE target IS NOT NULL UNION ALL SELECT 'target', 'matches', 1 FROM d WHERE matches UNION ALL SELECT 'target', 'repaired', 1 FROM d WHERE target IS NOT NULL AND k % 6 = 1 UNION ALL SELECT 'target', 'rewritten', 1 FROM d WHERE target IS NOT NULL AND k % 8 = 1
  UNION ALL SELECT 'target mode', target, 1 FROM d WHERE target IS NOT NULL UNION ALL SELECT 'target observed', outcome, 1 FROM d WHERE target IS NOT NULL UNION ALL SELECT 'repaired by target', target, 1 FROM d WHERE target IS NOT NULL AND k % 6 = 1
  UNION ALL SELECT 'rewritten by target', target, 1 FROM d WHERE target IS NOT NULL AND k % 8 = 1 UNION ALL SELECT 'generation attempts', (k % 3 + 1)::VARCHAR, 1 FROM d WHERE target IS NOT NULL UNION ALL SELECT 'rewrite attempts', (k % 2)::VARCHAR, 1 FROM d WHERE target IS NOT NULL AND k % 2 > 0
  UNION ALL SELECT 'style assigned', style, 1 FROM d WHERE style IS NOT NULL UNION ALL SELECT 'style observed', unnest(cues), 1 FROM d WHERE style IS NOT NULL UNION ALL SELECT 'corpus', 'with_context', 1 FROM d
  UNION ALL SELECT 'target', 'retried', 1 FROM d WHERE matches AND k % 6 <> 1 AND k % 8 <> 1 AND k % 3 > 0 UNION ALL SELECT 'mask', lower(unnest(list_filter(found, lambda p: list_contains({_list(K.STANDARD_PLACEHOLDERS)}, p)))[9:-2]), 1 FROM w
  UNION ALL SELECT 'cues', 'attacker_turns', 1 FROM w WHERE speaker = 'attacker' UNION ALL SELECT 'cues', 'with_cue', 1 FROM w WHERE speaker = 'attacker' AND len(cues) > 0 UNION ALL SELECT 'cues', 'urgent', 1 FROM w WHERE speaker = 'attacker' AND list_contains(cues, 'urgency')
  UNION ALL SELECT 'cue', unnest(cues), 1 FROM w WHERE speaker = 'attacker' UNION ALL SELECT 'signal', 'stage_direction_count', CASE WHEN contains(phrase, '[한숨]') THEN 1 ELSE 0 END FROM w UNION ALL SELECT 'signal', 'mask_usage_anomaly_count', 1 FROM w WHERE {_re('phrase', K.OTP_TRANSFER)}
  UNION ALL SELECT 'signal', 'unknown_masked_placeholder_count', CASE WHEN contains(phrase, '[MASKED_MEMBER_STATUS]') THEN 1 ELSE 0 END FROM w UNION ALL SELECT 'placeholder', '[MASKED_MEMBER_STATUS]', 1 FROM w WHERE contains(phrase, '[MASKED_MEMBER_STATUS]')
  UNION ALL SELECT 'signal', 'partial_compliance_signal_count', 1 FROM w WHERE speaker = 'victim' AND {_HAS('phrase')} AND {_any('lower(phrase)', K.COMPLIANCE_KEYWORDS)} UNION ALL SELECT 'signal', 'korean_entity_warning_count', 1 FROM w WHERE {_re(f"regexp_replace(phrase, '{_MASK}', '', 'g')", K.ENTITY)})
"""


@registered(_LONG + """SELECT section, key, sum(n)::BIGINT AS n, NULL::BIGINT AS repeats FROM l GROUP BY section, key
UNION ALL SELECT 'utterance', '', sum(n)::BIGINT, sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM u GROUP BY lower(regexp_replace(phrase, '\\s+', '', 'g')))""")
def quality_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every count of a corpus's report, from one pass."""
    found = quality.figures(*_corpus(spark, sf_dir))
    return found.select("section", "key", "n", F.when(F.col("section") == "utterance", F.col("repeats")).alias("repeats"))


@registered(_LONG.partition("\nw AS (")[0].rstrip(",") + f""", x AS (SELECT *, CASE target WHEN 'masked_compromise' THEN 'compromised' ELSE target END AS due, array_to_string(list_filter({_list(K.CONTEXT_FIELDS)}, lambda f, i: k % (i + 2) = 0), ', ') AS missing FROM d),
re AS (SELECT 'target_mismatch_examples' AS kind, id, k, due AS expected, outcome AS observed FROM x WHERE outcome <> due UNION ALL SELECT 'style_mismatch_examples', id, k, style, array_to_string(list_sort(cues), ', ') FROM x WHERE style IS NOT NULL AND NOT list_contains(cues, style)
  UNION ALL SELECT 'urgency_leakage_examples', id, k, style, 'urgency' FROM x WHERE style <> 'urgency' AND list_contains(cues, 'urgency') UNION ALL SELECT 'missing_context_examples', id, k, 'environmental_context', missing FROM x WHERE missing <> '')
SELECT kind, place::INT AS place, id AS record_id, expected, observed FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY k) AS place FROM re) WHERE place <= 10""")
def quality_record_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the first ten records of each kind that are not as they were to be."""
    rows = _corpus(spark, sf_dir)[0].withColumn("k", F.col("id").cast("bigint"))
    return quality.record_examples(rows, order="k")


@registered(_SPOKEN.rstrip() + f""", w AS (SELECT stream_id, turn_id, phrase, unnest(list_filter([CASE WHEN contains(phrase, '[한숨]') THEN 'stage_direction_examples' END, CASE WHEN {_re('phrase', K.OTP_TRANSFER)} THEN 'mask_usage_anomaly_examples' END,
  CASE WHEN contains(phrase, '[MASKED_MEMBER_STATUS]') THEN 'unknown_masked_placeholder_examples' END, CASE WHEN speaker = 'victim' AND {_HAS('phrase')} AND {_any('lower(phrase)', K.COMPLIANCE_KEYWORDS)} THEN 'partial_compliance_examples' END,
  CASE WHEN {_re(f"regexp_replace(phrase, '{_MASK}', '', 'g')", K.ENTITY)} THEN 'korean_entity_warnings' END], lambda x: x IS NOT NULL)) AS kind FROM u),
p AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY stream_id::BIGINT, turn_id)::INT AS place FROM w)
SELECT kind, place, stream_id AS record_id, turn_id, phrase AS utterance FROM p WHERE place <= 10""")
def quality_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the first ten turns of each kind that a reader should look at."""
    return quality.all_examples(_corpus(spark, sf_dir)[1])


def _joined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = stream.build_planned_items(_item_records(spark, sf_dir), {})
    return shortcuts.joined(items["public"], items["manifest"], items["gold"]).withColumn("ord", F.struct("stream_id", "position", "benchmark_id"))


_ITEM_ROWS = _SPOKEN.rstrip() + f""", b AS (SELECT stream_id, bool_or(contains(phrase, '[한숨]')) AS bracket FROM u GROUP BY stream_id),
i AS (SELECT turn_id, phrase AS text, turn_id = 2 AS fallback, CASE WHEN turn_id % 2 = 0 THEN 'needs_more_context' ELSE 'new_sensitive_request' END AS event, CASE WHEN turn_id % 2 = 0 THEN 'monitor_only' ELSE 'refuse_or_pause' END AS action,
  CASE WHEN turn_id % 2 = 1 THEN 'caller' ELSE 'recipient' END || ':' || turn_id || ':' || array_to_string(list_sort(list_distinct(regexp_extract_all(phrase, '\\[MASKED_([A-Z0-9_]+)\\]', 1))), ',') || ':' || {_names('phrase', shortcuts.ACTION_CUES, False)} AS shape,
  CASE WHEN {_any('phrase', K.SHORT_UTTERANCES)} OR len(regexp_extract_all(regexp_replace(phrase, '{_MASK}', ' ', 'g'), '[가-힣]')) < 9 THEN 'very_short_utterance' END AS artifact, {_any('phrase', K.LEAKAGE_TERMS)} AS leaks,
  'streamv2_' || substr(sha256(stream_id || '␟typed_raw'), 1, 12) AS stream FROM u JOIN b USING (stream_id) WHERE NOT bracket AND turn_id % 4 <> 0),
s AS (SELECT *, ('0x' || substr(sha1(stream), 1, 8))::BIGINT % 2 AS side FROM i),
"""


@registered(_ITEM_ROWS + """m AS (SELECT 'profile_position' AS model, turn_id::VARCHAR AS feature, event AS label, side, stream, turn_id FROM s UNION ALL SELECT 'position', turn_id::VARCHAR, event, side, stream, turn_id FROM s
  UNION ALL SELECT CASE WHEN fallback THEN 'fallback_text' ELSE 'normal_text' END, text, event, side, stream, turn_id FROM s UNION ALL SELECT 'dominance', event, action, side, stream, turn_id FROM s UNION ALL SELECT 'branch ' || event, shape, action, side, stream, turn_id FROM s
  UNION ALL SELECT 'rows', '', '', side, stream, turn_id FROM s UNION ALL SELECT 'fallback', '', '', side, stream, turn_id FROM s WHERE fallback UNION ALL SELECT 'artifact ' || artifact, '', '', side, stream, turn_id FROM s WHERE artifact IS NOT NULL UNION ALL SELECT 'leaks', '', '', side, stream, turn_id FROM s WHERE leaks),
c AS (SELECT model, feature, label, count(*) AS n, count(*) FILTER (side = 0) AS train, count(*) FILTER (side = 1) AS test, min((stream, turn_id)) FILTER (side = 0) AS first FROM m GROUP BY model, feature, label),
o AS (SELECT model, label AS usual FROM (SELECT model, label, row_number() OVER (PARTITION BY model ORDER BY sum(train) DESC, min(first)) AS k FROM c GROUP BY model, label HAVING sum(train) > 0) WHERE k = 1),
g AS (SELECT model, feature, label AS guess FROM (SELECT *, row_number() OVER (PARTITION BY model, feature ORDER BY train DESC, first) AS k FROM c WHERE train > 0) WHERE k = 1),
f AS (SELECT c.model, c.feature, sum(n) AS n, max(n) AS hits, count(*) AS labels, sum(test) AS test, sum(test) FILTER (label = COALESCE(guess, usual)) AS good, bool_and(guess IS NULL) AS unseen FROM c LEFT JOIN g ON g.model = c.model AND g.feature = c.feature LEFT JOIN o ON o.model = c.model GROUP BY c.model, c.feature)
SELECT model, CASE WHEN model = 'dominance' THEN feature ELSE '' END AS feature, sum(n)::BIGINT AS n, sum(hits)::BIGINT AS hits, count(*) AS features, count(*) FILTER (n >= 2) AS repeated, COALESCE(sum(n) FILTER (n >= 2), 0)::BIGINT AS repeated_n, COALESCE(sum(hits) FILTER (n >= 2), 0)::BIGINT AS repeated_hits,
  count(*) FILTER (n >= 5 AND labels = 1) AS single, sum(test)::BIGINT AS test_count, COALESCE(sum(good) FILTER (model NOT IN ('rows', 'fallback', 'leaks') AND model NOT LIKE 'artifact %'), 0)::BIGINT AS test_hits, COALESCE(sum(test) FILTER (unseen), 0)::BIGINT AS unseen FROM f GROUP BY ALL""")
def shortcut_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All majority models of the shortcut report, from one pass: by profile and position, by text, by event, by what a turn looks like."""
    counts = shortcuts.model_figures(_joined_items(spark, sf_dir))
    plain = F.col("model").isin("rows", "fallback", "leaks") | F.col("model").startswith("artifact ")
    hits = F.when(plain, F.lit(0)).otherwise(F.coalesce("test_hits", F.lit(0))).cast("bigint")
    return counts.where("model <> 'variant'").select("model", "feature", "n", "hits", "features", "repeated", "repeated_n", "repeated_hits", "single", "test_count", hits.alias("test_hits"), "unseen")


@registered(_ITEM_ROWS + """c AS (SELECT CASE WHEN fallback THEN 'fallback' ELSE 'non_fallback' END AS kind, text, count(*) AS n, count(DISTINCT event) AS events, min(event) AS event, min((stream, turn_id)) AS first FROM s GROUP BY ALL),
l AS (SELECT 'top_' || kind || '_strings' AS list, row_number() OVER (PARTITION BY kind ORDER BY n DESC, first) AS place, text AS utterance, n AS count FROM c UNION ALL SELECT 'high_count_single_event_' || kind || '_strings', row_number() OVER (PARTITION BY kind ORDER BY n DESC, text), text, n FROM c WHERE n >= 5 AND events = 1
  UNION ALL SELECT 'very_short_turn_examples', row_number() OVER (ORDER BY stream, turn_id), text, NULL FROM s WHERE artifact IS NOT NULL UNION ALL SELECT 'category_leakage_examples', row_number() OVER (ORDER BY stream, turn_id), text, NULL FROM s WHERE leaks)
SELECT list, place::INT AS place, utterance, count FROM l WHERE place <= 20""")
def shortcut_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k reports: the strings and turns that the shortcut report shows, twenty of each kind."""
    return shortcuts.report_lists(_joined_items(spark, sf_dir)).select("list", "place", "utterance", "count")


@registered(_LONG + """, su AS (SELECT section || '/' || key AS k, sum(n) AS n FROM l GROUP BY ALL), v AS (SELECT sum(n) FILTER (k = 'target/assigned') AS assigned, COALESCE(sum(n) FILTER (k = 'target/matches'), 0) AS matches, COALESCE(sum(n) FILTER (k = 'target/repaired'), 0) AS repaired,
  COALESCE(sum(n) FILTER (k = 'signal/stage_direction_count'), 0) AS directions, COALESCE(sum(n) FILTER (k = 'placeholder/[MASKED_MEMBER_STATUS]'), 0) AS unclassified FROM su),
rep AS (SELECT sum(n - 1) / sum(n) AS repeats FROM (SELECT count(*) AS n FROM u GROUP BY lower(regexp_replace(phrase, '\\s+', '', 'g'))))
SELECT unnest(list_filter([CASE WHEN matches < assigned THEN 'target_outcome_alignment_below_final_threshold' END, CASE WHEN repaired / assigned > 0.25 THEN 'target_outcome_repair_rate_above_final_threshold' END, CASE WHEN repeats > 0.2 THEN 'duplicate_utterance_rate_above_final_threshold' END,
  CASE WHEN directions > 0 THEN 'stage_direction_present' END, CASE WHEN unclassified > 0 THEN 'unknown_placeholder_unclassified_review_required' END], lambda x: x IS NOT NULL)) AS reason, 'final_review' AS gate FROM v, rep""")
def final_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a corpus needs a look, and which gate of a final run fails for it."""
    report = quality.report(*_corpus(spark, sf_dir))
    gates_ = quality.failed_gates(report, 0, final=True)
    return spark.createDataFrame([(reason, gate) for reason in report["final_review"]["reasons"] for gate in gates_], "reason string, gate string")


def _rounded(c: str) -> str:
    return f"round_even({c}, 4)"


@registered(_EVENTS + f""", t AS (SELECT c.run, sum(cost) + any_value(late) AS total, count(*) FILTER (ga AND NOT pa) AS missed, count(*) FILTER (ga) AS due, count(*) FILTER (pa AND NOT ga) AS false_active, count(*) FILTER (NOT ga) AS quiet, count(*) FILTER (pa AND NOT ga AND alerted) AS again, count(*) AS n
FROM c JOIN (SELECT run, sum(CASE WHEN came > due THEN least(2.0, 0.5 * (came - due)) ELSE 0 END)::DOUBLE AS late FROM s GROUP BY run) l ON c.run = l.run GROUP BY c.run)
SELECT run, {_rounded('100 * total / n')} AS weighted_cost_per_100, {_rounded('100 - least(100, ' + _rounded('100 * total / n') + ')')} AS ssu, {_rounded('missed / due')} AS missed_actionable_rate, {_rounded('false_active / quiet')} AS false_active_rate, {_rounded('again / n')} AS duplicate_alert_rate FROM t""")
def rounded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published figures of each predictor, rounded half to even at four places."""
    rows = [(r["run"], score.rounded(r.asDict())) for r in score.score(*event_items(spark, sf_dir)).collect()]
    names = {"weighted_cost_per_100": "weighted_cost_per_100", "ssu": "SSU", "missed_actionable_rate": "missed_actionable_rate", "false_active_rate": "false_active_rate", "duplicate_alert_rate": "duplicate_alert_rate"}
    return spark.createDataFrame([(run, *(float(r[k]) for k in names.values())) for run, r in rows], "run string, " + ", ".join(f"{k} double" for k in names))
