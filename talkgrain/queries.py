"""The registered queries over the driver's tables, and what they say in SQL.

Conversations stand for dialogues (users call, assistants receive), events for
the turns of streams, star-schema keys for catalogs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import ids, masking, text
from talkgrain.operators import quality, records, score, shortcuts, stream
from talkgrain.plans import schedule
from talkgrain.sources import jsonl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by keys over all cores, before each is much work: a table that is one block is one task else."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.when(F.col("role") == "user", "attacker").when(F.col("role") == "assistant", "victim").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("stream_id"), (F.col("turn") + 1).cast("int").alias("turn_id"), speaker.alias("speaker"), F.col("text").alias("utterance"))


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records: ids, an array of turns, and the fields that checks read; with no masked items, as no text is masked."""
    none = F.array().cast("array<struct<label:string,placeholder:string>>")
    turn = F.struct("turn_id", "speaker", "utterance", F.lit("").alias("risk_signal"), none.alias("masked_items"))
    rows = conversation_turns(spark, sf_dir).groupBy("stream_id").agg(F.array_sort(F.collect_list(turn)).alias("dialogue"))
    return rows.select(F.col("stream_id").alias("id"), "dialogue", F.lit("attack").alias("label"), F.array(F.lit("urgency")).alias("risk_labels"), F.lit("en").alias("locale"))


def event_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as items, gold and predictions: purchases and errors are due an alert; two predictors go by the value and the kind."""
    from pyspark.sql import Window as W

    rows = table(spark, sf_dir, "events").withColumn("position", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")))
    key = F.col("event_id").cast("string").alias("benchmark_id")
    public = rows.select(key, F.col("user_id").cast("string").alias("stream_id"), "position", F.array("position").alias("window_ids"))
    due = F.when(F.col("event_type") == "error", "recovery_followup_due").when(F.col("event_type") == "purchase", "new_sensitive_request").otherwise("no_new_actionable_event")
    shaped = lambda event: [event.alias("event"), stream.action_of(event).alias("action"), stream.rules_of(event).alias("policy_rule_ids"), F.array("position").alias("evidence_turn_ids")]
    gold = rows.select(key, *shaped(due))
    by_value = F.when(F.col("value") > 50, "new_sensitive_request").otherwise("no_new_actionable_event")
    by_kind = F.when(F.col("event_type").isin("error", "click"), "recovery_followup_due").otherwise("needs_more_context")
    return public, gold, rows.select(F.lit("by_value").alias("run"), key, *shaped(by_value)).unionByName(rows.select(F.lit("by_kind").alias("run"), key, *shaped(by_kind)))


# Turns and windows.

_TURNS = """WITH t AS (SELECT conv_id::VARCHAR AS stream_id, (turn + 1)::INT AS turn_id,
  CASE role WHEN 'user' THEN 'attacker' WHEN 'assistant' THEN 'victim' ELSE role END AS speaker, text AS utterance FROM conversations)"""


@registered(_TURNS + """, w AS (SELECT *, list(turn_id) OVER p AS ids, sum(length(utterance)) OVER p AS n FROM t
  WINDOW p AS (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT stream_id, turn_id, len(ids)::INT AS window_turns, array_to_string(ids, ',') AS window_ids, n::BIGINT AS window_chars FROM w""")
def window_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream.sliding_windows(conversation_turns(spark, sf_dir), stream="stream_id", position="turn_id", fields=("speaker", "utterance"))
    ids_ = F.array_join(F.transform("window", lambda t: t["turn_id"].cast("string")), ",")
    chars = F.aggregate("window", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t["utterance"]))
    return rows.select("stream_id", "turn_id", F.size("window").alias("window_turns"), ids_.alias("window_ids"), chars.alias("window_chars"))


@registered(_TURNS + "SELECT turn_id, count(*) AS items, count(DISTINCT stream_id) AS streams FROM t GROUP BY turn_id")
def items_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_turns(spark, sf_dir).groupBy("turn_id").agg(F.count("*").alias("items"), F.count_distinct("stream_id").alias("streams"))


@registered(_TURNS + """SELECT stream_id, turn_id, CASE speaker WHEN 'attacker' THEN 'caller' ELSE 'recipient' END AS speaker, md5(utterance) AS digest FROM t""")
def public_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = conversation_records(spark, sf_dir).select("id", F.explode(stream.public_turns(F.col("dialogue"))).alias("t"))
    return seen.select(F.col("id").alias("stream_id"), "t.turn_id", "t.speaker", F.md5("t.utterance").alias("digest"))


@registered(_TURNS + """, n AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY turn_id) - 1 AS k, lower(regexp_replace(utterance, '\\s+', '', 'g')) AS key FROM t)
SELECT stream_id AS id, count(*)::INT AS turn_count, bool_and(speaker = CASE WHEN k % 2 = 0 THEN 'attacker' ELSE 'victim' END) AS role_order_valid, count(DISTINCT key) = count(*) AS no_duplicate_turns,
  'inconclusive' AS outcome FROM n GROUP BY stream_id""")
def record_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.with_facts(conversation_records(spark, sf_dir))
    return rows.select("id", *(f"facts.{c}" for c in ("turn_count", "role_order_valid", "no_duplicate_turns", "outcome")))


@registered(_TURNS + """SELECT stream_id, turn_id, ['opening','establish_context','make_request','handle_resistance','close'][least((turn_id - 1) // 2, 4) + 1] AS phase,
  CASE WHEN stream_id::INT % 10 < 8 THEN 'train' WHEN stream_id::INT % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM t""")
def phases_and_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_turns(spark, sf_dir).select("stream_id", "turn_id", schedule.phase_for_turn(F.col("turn_id")).alias("phase"), schedule.split_for_index(F.col("stream_id").cast("int")).alias("split"))


@registered(_TURNS + """SELECT turn_id, stream_id, CASE WHEN length(n) <= 160 THEN n ELSE substr(n, 1, 157) || '...' END AS shown
FROM (SELECT *, trim(regexp_replace(utterance, '\\s+', ' ', 'g')) AS n FROM t)""")
def truncated_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_turns(spark, sf_dir).select("turn_id", "stream_id", text.truncated(F.col("utterance")).alias("shown"))


@registered("""SELECT doc_id, greatest(1, len(list_filter(list_transform(regexp_extract_all(COALESCE(text, ''), '[^.!?\\n。！？]+[.!?。！？]?'), lambda x: trim(x, ' \t\r')), lambda x: x <> '')))::INT AS sentences FROM documents""")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", text.sentence_count(F.coalesce("text", F.lit(""))).alias("sentences"))


# Identity.

@registered("""SELECT doc_id, 'ssi_' || substr(sha256('family␟' || doc_id::VARCHAR || '␟' || COALESCE(source, 'None')), 1, 12) AS stable_id,
  'set-' || substr(sha1('set:' || COALESCE(source, 'None') || ':' || COALESCE(lang, 'None') || ':plain:' || doc_id::VARCHAR), 1, 12) AS record_id,
  (('0x' || substr(sha1(doc_id::VARCHAR), 1, 8))::BIGINT % 2)::BIGINT AS bucket FROM documents""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", ids.stable_id("ssi", "family", key, F.col("source")).alias("stable_id"), ids.record_id(F.lit("set"), F.col("source"), F.col("lang"), F.lit("plain"), key).alias("record_id"), ids.hash_bucket(key.cast("string"), 2).alias("bucket"),
    )


# Masking.

_MASKED = r"""regexp_replace(regexp_replace({c}, '(?i)https?://[^\s]+|www\.[^\s]+', '[MASKED_URL]', 'g'), '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}\b', '[MASKED_EMAIL]', 'g')"""


@registered(f"SELECT doc_id, md5({_MASKED.format(c="COALESCE(text, '')")}) AS digest, (len(regexp_extract_all({_MASKED.format(c="COALESCE(text, '')")}, '\\[MASKED_(URL|EMAIL)\\]')))::INT AS masks FROM documents")
def mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", masking.mask_text(F.coalesce("text", F.lit(""))).alias("m"))
    return rows.select("doc_id", F.md5("m.text").alias("digest"), F.size("m.masked_items").alias("masks"))


@registered(r"""SELECT label, count(*) AS n FROM (
  SELECT unnest(list_filter([CASE WHEN regexp_matches(url, '(?i)https?://[^\s]+|www\.[^\s]+') THEN 'url' END, CASE WHEN regexp_matches(url, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b') THEN 'email' END], lambda x: x IS NOT NULL)) AS label FROM pages)
GROUP BY label""")
def residual_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.residual_patterns(table(spark, sf_dir, "pages"), "url")


# Quality of a corpus.

@registered("""SELECT sum(n - 1)::BIGINT AS duplicates, sum(n)::BIGINT AS n FROM (SELECT count(*) AS n FROM documents GROUP BY lower(regexp_replace(COALESCE(text, ''), '\\s+', '', 'g')))""")
def duplicate_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_utterances(table(spark, sf_dir, "documents"), "text")


@registered("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_ids(table(spark, sf_dir, "orders"), "o_custkey")


@registered("SELECT COALESCE(source, 'unknown') AS value, count(*) AS n FROM documents GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_counts(table(spark, sf_dir, "documents"), "source")


@registered("""SELECT unnest(['good', 'clean']) AS flag, unnest([count(*) FILTER (quality = 1), count(*) FILTER (toxic = 0)]) AS pass, unnest([count(*) FILTER (quality <> 1), count(*) FILTER (toxic <> 0)]) AS fail,
  unnest([count(*) FILTER (quality IS NULL), count(*) FILTER (toxic IS NULL)]) AS missing FROM documents LEFT JOIN labels USING (doc_id)""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.quality_checks(rows.select(F.struct((F.col("quality") == 1).alias("good"), (F.col("toxic") == 0).alias("clean")).alias("quality_checks")), ("good", "clean"))


@registered(_TURNS + """SELECT CASE WHEN NOT regexp_matches(utterance, '[가-힣A-Za-z0-9]') THEN 'placeholder_only_utterance' ELSE 'very_short_utterance' END AS artifact, count(*) AS n FROM t WHERE len(regexp_extract_all(utterance, '[가-힣]')) < 9 GROUP BY 1""")
def utterance_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_turns(spark, sf_dir).groupBy(text.utterance_artifact(F.col("utterance")).alias("artifact")).agg(F.count("*").alias("n")).where("artifact IS NOT NULL")


# Scores.

_EVENTS = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events),
a AS (SELECT *, CASE event_type WHEN 'error' THEN 'recovery_followup_due' WHEN 'purchase' THEN 'new_sensitive_request' ELSE 'no_new_actionable_event' END AS gold_event FROM r),
p AS (SELECT a.*, run, CASE WHEN run = 'by_value' THEN CASE WHEN value > 50 THEN 'new_sensitive_request' ELSE 'no_new_actionable_event' END
    ELSE CASE WHEN event_type IN ('error', 'click') THEN 'recovery_followup_due' ELSE 'needs_more_context' END END AS event FROM a, (VALUES ('by_value'), ('by_kind')) v(run)),
f AS (SELECT *, gold_event <> 'no_new_actionable_event' AS ga, event IN ('new_sensitive_request', 'recovery_followup_due') AS pa FROM p),
w AS (SELECT *, COALESCE(bool_or(pa) OVER (PARTITION BY run, user_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS alerted FROM f),
c AS (SELECT *, CASE WHEN ga AND NOT pa THEN CASE gold_event WHEN 'recovery_followup_due' THEN 5.0 ELSE 3.0 END WHEN pa AND NOT ga THEN CASE WHEN alerted THEN 3.0 ELSE 2.0 END WHEN ga AND pa AND event <> gold_event THEN 1.0 ELSE 0.0 END::DOUBLE AS cost FROM w),
s AS (SELECT run, user_id, min(position) FILTER (ga) AS due, min(position) FILTER (pa) AS came FROM c GROUP BY ALL)
"""


@registered(_EVENTS + "SELECT run, event_id::VARCHAR AS benchmark_id, cost, ga AND NOT pa AS missed, pa AND NOT ga AS false_active, pa AND NOT ga AND alerted AS duplicate_alert FROM c")
def item_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.scored_items(*event_items(spark, sf_dir)).select("run", "benchmark_id", "cost", "missed", "false_active", "duplicate_alert")


@registered(_EVENTS + """SELECT c.run, sum(cost) + any_value(late) AS total_penalty, count(*) FILTER (ga AND NOT pa) AS missed, count(*) FILTER (ga) AS actionable, count(*) FILTER (pa AND NOT ga) AS false_active,
  count(*) FILTER (pa AND NOT ga AND alerted) AS duplicate_alerts, 100 * (sum(cost) + any_value(late)) / (SELECT count(*) FROM events) AS cost_per_100
FROM c JOIN (SELECT run, sum(CASE WHEN came > due THEN least(2.0, 0.5 * (came - due)) ELSE 0 END)::DOUBLE AS late FROM s GROUP BY run) l ON c.run = l.run GROUP BY c.run""")
def ssu_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score(*event_items(spark, sf_dir)).select("run", "total_penalty", "missed", "actionable", "false_active", "duplicate_alerts", "cost_per_100")


@registered(_EVENTS + """, l AS (SELECT run, came - due AS wait, row_number() OVER (PARTITION BY run ORDER BY came - due, user_id) AS k, count(*) OVER (PARTITION BY run) AS n FROM s WHERE came >= due)
SELECT run, avg(wait) AS mean_turn_latency, median(wait) AS median_turn_latency, max(wait) FILTER (k = round_even((n - 1) * 0.95, 0)::INT + 1)::DOUBLE AS p95_turn_latency, max(wait)::INT AS max_turn_latency FROM l GROUP BY run""")
def alert_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = score.scored_items(*event_items(spark, sf_dir))
    return score.latencies(items).select("run", "mean_turn_latency", "median_turn_latency", "p95_turn_latency", "max_turn_latency")


@registered("""WITH p AS (SELECT CASE quality WHEN 1 THEN 'yes' ELSE 'no' END AS a, CASE toxic WHEN 0 THEN 'yes' ELSE 'no' END AS b FROM labels),
l AS (SELECT x, 2 * count(*) FILTER (a = x AND b = x) / (count(*) FILTER (a = x) + count(*) FILTER (b = x))::DOUBLE AS f FROM p, (VALUES ('yes'), ('no')) v(x) GROUP BY x)
SELECT 'all' AS run, avg(f) AS f1 FROM l""")
def macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = lambda c: F.when(c, "yes").otherwise("no")
    items = table(spark, sf_dir, "labels").select(F.lit("all").alias("run"), F.lit(True).alias("on_gold"), F.lit(True).alias("predicted"), yes(F.col("quality") == 1).alias("p"), yes(F.col("toxic") == 0).alias("g"))
    return score.macro_f1(items, ("yes", "no"), "p", "g")


@registered("""WITH u AS (SELECT user_id, list_distinct(list(event_type) FILTER (value > 50)) AS a, list_distinct(list(event_type) FILTER (value <= 50)) AS b FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN COALESCE(len(a), 0) + COALESCE(len(b), 0) = 0 THEN 1.0 ELSE 2.0 * COALESCE(len(list_intersect(a, b)), 0) / (COALESCE(len(a), 0) + COALESCE(len(b), 0)) END::DOUBLE AS f1 FROM u""")
def set_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = lambda c: F.collect_set(F.when(c, F.col("event_type")))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(kinds(F.col("value") > 50).alias("a"), kinds(F.col("value") <= 50).alias("b"))
    return rows.select("user_id", score.set_f1(F.col("a"), F.col("b")).alias("f1"))


@registered(_TURNS + """, w AS (SELECT *, count(*) OVER (PARTITION BY stream_id ORDER BY turn_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS n FROM t),
e AS (SELECT unnest([('always_active', 'new_sensitive_request'), ('never_active', 'no_new_actionable_event'), ('caller_turn_only', CASE speaker WHEN 'attacker' THEN 'new_sensitive_request' ELSE 'no_new_actionable_event' END),
  ('position_only', CASE WHEN turn_id >= 3 THEN 'new_sensitive_request' ELSE 'needs_more_context' END), ('current_keyword', 'needs_more_context'), ('prefix_keyword', 'needs_more_context'), ('placeholder_count_or_type', 'needs_more_context'),
  ('repeat_prior_state', 'needs_more_context'), ('static_verify', 'pressure_escalation'), ('static_refuse', 'new_sensitive_request'), ('static_preserve_on_any_mask', 'needs_more_context'),
  ('window_length_only', CASE WHEN n >= 4 THEN 'new_sensitive_request' ELSE 'needs_more_context' END), ('shuffled_dialogue', 'needs_more_context')]) AS b FROM w)
SELECT b[1] AS run, b[2] AS event, count(*) AS n FROM e GROUP BY ALL""")
def baseline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_records(spark, sf_dir).select("dialogue", "id", F.explode("dialogue").alias("t"))
    public = rows.select(F.concat("id", F.lit("/"), F.col("t.turn_id").cast("string")).alias("benchmark_id"), F.col("t.turn_id").alias("stream_position"), F.struct(stream.last_of(stream.public_turns(F.col("dialogue"), upto=F.col("t.turn_id")), 6).alias("dialogue_window")).alias("input"))
    return score.baseline_predictions(public).groupBy("run", "event").agg(F.count("*").alias("n"))


# Shortcuts.

@registered("SELECT sum(best)::BIGINT AS hits, sum(total)::BIGINT AS n FROM (SELECT max(n) AS best, sum(n) AS total FROM (SELECT user_id % 10 AS f, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY f)")
def majority_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortcuts.majority_hits(table(spark, sf_dir, "events").withColumn("f", F.col("user_id") % 10), ["f"], "event_type")


@registered("""WITH e AS (SELECT user_id % 10 AS f, event_type AS l, event_id AS o, ('0x' || substr(sha1(user_id::VARCHAR), 1, 8))::BIGINT % 2 AS side FROM events),
t AS (SELECT f, l, count(*) AS n, min(o) AS o FROM e WHERE side = 0 GROUP BY ALL), g AS (SELECT f, arg_max(l, (n, -o)) AS guess FROM t GROUP BY f),
a AS (SELECT arg_max(l, (n, -o)) AS overall FROM (SELECT l, count(*) AS n, min(o) AS o FROM e WHERE side = 0 GROUP BY l))
SELECT count(*) FILTER (COALESCE(guess, overall) = l) AS hits, count(*) FILTER (guess IS NULL) AS unseen, count(*) AS test_count, (SELECT count(*) FROM e) AS support, (SELECT count(DISTINCT l) FROM e) AS unique_label_count
FROM e LEFT JOIN g USING (f), a WHERE side = 1""")
def train_test_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("f"), F.col("event_type").alias("l"), "user_id", F.col("event_id").alias("ord"))
    return shortcuts.train_test_majority(rows, feature="f", label="l", split_key="user_id", order="ord")


@registered("""WITH c AS (SELECT event_type AS event, CASE WHEN value > 75 THEN 'high' WHEN value > 25 THEN 'mid' ELSE 'low' END AS action, count(*) AS n, min(event_id) AS o FROM events GROUP BY ALL)
SELECT event, sum(n)::BIGINT AS count, arg_max(action, (n, -o)) AS dominant_action, max(n) AS dominant_action_count FROM c GROUP BY event""")
def event_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.when(F.col("value") > 75, "high").when(F.col("value") > 25, "mid").otherwise("low")
    return shortcuts.dominance(table(spark, sf_dir, "events").select(F.col("event_type").alias("event"), band.alias("action"), F.col("event_id").alias("ord")))


@registered("""SELECT g, count(DISTINCT s) AS sequences FROM (SELECT user_id % 5 AS g, user_id, list(event_type ORDER BY event_id) AS s FROM events GROUP BY ALL) GROUP BY g""")
def unique_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("g"), "user_id", "event_id", "event_type")
    return shortcuts.unique_sequences(rows, group="g", stream="user_id", position="event_id", event="event_type")


@registered("SELECT text, count(*) AS n, count(DISTINCT role) AS events, min(role) AS event FROM conversations GROUP BY text")
def string_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortcuts.string_concentration(table(spark, sf_dir, "conversations"), text="text", event="role")


@registered("SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, source LIMIT 20")
def top_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortcuts.top_strings(table(spark, sf_dir, "documents"), text="source")


# Schedules and joins.

@registered("""WITH i AS (SELECT range AS index FROM range(240)), v AS (SELECT n_nationkey AS pos, n_name AS id FROM nation), a AS (SELECT r_regionkey AS pos, r_name AS id FROM region)
SELECT index, v.id AS victim_id, a.id AS attacker_id, ['one', 'two', 'three'][index % 3 + 1] AS scenario_type, ['urgency', 'authority', 'consequence', 'relationship_or_emotional_pressure', 'process_control'][index % 5 + 1] AS pressure_style,
  CASE WHEN (index // 3) % 3 = 2 THEN 'inconclusive' ELSE 'defended_success' END AS target_outcome_mode, CASE WHEN index % 10 < 8 THEN 'train' WHEN index % 10 = 8 THEN 'val' ELSE 'test' END AS split,
  'dataset-' || substr(sha1('dataset:' || v.id || ':' || a.id || ':' || ['one', 'two', 'three'][index % 3 + 1] || ':' || index::VARCHAR), 1, 12) AS record_id
FROM i JOIN v ON v.pos = index % 25 JOIN a ON a.pos = (index // 25 + index) % 5""")
def schedule_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    victims = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("id"))
    attackers = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("pos"), F.col("r_name").alias("id"))
    scenarios = spark.createDataFrame([(0, "one"), (1, "two"), (2, "three")], "pos int, scenario string")
    rows = schedule.schedule(spark, victims, attackers, scenarios, count=240)
    return rows.select("index", "victim_id", "attacker_id", "scenario_type", "pressure_style", "target_outcome_mode", "split", "record_id")


@registered("""SELECT count(*) FILTER (g IS NOT NULL AND p IS NULL) AS missing, count(*) FILTER (g IS NULL AND p IS NOT NULL) AS extra, count(*) FILTER (g IS NOT NULL AND p IS NOT NULL) AS matched
FROM (SELECT DISTINCT doc_id AS g FROM documents) a FULL JOIN (SELECT DISTINCT doc_id + 100 AS p FROM labels) b ON g = p""")
def missing_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, a hundred ids on, as predictions for documents."""
    shaped = lambda key: [key.cast("string").alias("benchmark_id"), F.lit("needs_more_context").alias("event"), F.lit("monitor_only").alias("action"), F.array(F.lit("P_MONITOR")).alias("policy_rule_ids"), F.array(F.lit(1)).alias("evidence_turn_ids")]
    docs, key = table(spark, sf_dir, "documents"), F.col("doc_id")
    public = docs.select(key.cast("string").alias("benchmark_id"), key.cast("string").alias("stream_id"), F.lit(1).alias("position"), F.array(F.lit(1)).alias("window_ids"))
    found = score.score(public, docs.select(*shaped(key)), table(spark, sf_dir, "labels").select(F.lit("labels").alias("run"), *shaped(key + 100)))
    return found.select(F.col("missing_prediction_count").alias("missing"), F.col("extra_prediction_count").alias("extra"), F.col("matched_prediction_count").alias("matched"))


@registered("""SELECT k AS event_type, COALESCE(n, 0) AS n FROM (VALUES ('click'), ('view'), ('purchase'), ('error'), ('never')) v(k) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ON k = event_type""")
def dense_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.dense_counts(table(spark, sf_dir, "events"), "event_type", ("click", "view", "purchase", "error", "never"))


_ALERTS = """WITH r AS (SELECT user_id::VARCHAR AS stream_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position, event_type IN ('error', 'purchase') AS active FROM events)
SELECT stream_id, position, active, COALESCE(bool_or(active) OVER p, false) AS prior_alert, min(CASE WHEN active THEN position END) OVER p AS first_alert FROM r
WINDOW p AS (PARTITION BY stream_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def _alert_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    rows = table(spark, sf_dir, "events").withColumn("position", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint"))
    return rows.select(F.col("user_id").cast("string").alias("stream_id"), "position", F.col("event_type").isin("error", "purchase").alias("active"))


@registered(_ALERTS)
def alert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from talkgrain.streaming import alerts

    return alerts.alert_windows(_alert_turns(spark, sf_dir))


@registered(_ALERTS)
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stateful stream over files, with the state in a state store."""
    from talkgrain.streaming import alerts

    run = jsonl.scratch(spark, "alerts")
    alerts.replay(_alert_turns(spark, sf_dir), f"{run}/in")
    source = spark.readStream.schema("stream_id string, position long, active boolean").parquet(f"{run}/in")
    alerts.run_available(source, f"{run}/state", f"{run}/out")
    return spark.read.parquet(f"{run}/out").where("NOT late").drop("late", "late_dropped")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_items(spark, sf_dir)
