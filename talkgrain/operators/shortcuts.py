"""Whether labels leak through position, wording or repeated strings."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkgrain.functions.ids import hash_bucket
from talkgrain.functions.text import REPEATED_NOUN, contains_any, leakage_terms, placeholders, utterance_artifact

#: Words by which a window's surface is described (fixed values).
SURFACE_WORDS = (
    "공식", "저장된", "직접", "링크", "경로", "접속", "제공", "입력", "말씀", "전달", "공유", "확인", "필요", "긴급", "즉시", "오늘", "마감", "지연", "보류", "제한", "중단", "신고", "기록", "추가", "같은 방식", "새로운", "아직", "설명", "기다리", "처리",
)
#: Cues of a turn that bear on its action (fixed values).
ACTION_CUES = {
    "url_or_path": ("[MASKED_URL]", "링크", "경로", "포털", "접속"),
    "pressure": ("긴급", "즉시", "오늘", "마감", "지연", "보류", "제한", "차질"),
    "refusal": ("제공하지", "입력하지", "사용하지", "접속하지", "열지", "진행하지"),
    "official": ("공식", "저장된", "직접"),
    "disclosure": ("전달하겠습니다", "제공하겠습니다", "말씀드리겠습니다", "입력하겠습니다", "공유하겠습니다"),
    "recovery": ("중단", "보존", "신고", "기록", "복구"),
}


def majority(rows: DataFrame, keys: list[str], label: str, order: str) -> DataFrame:
    """``keys, label, hits, n``: the most frequent label of each key, of equals the one that came first."""
    counted = rows.groupBy(*keys, label).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    best = F.min_by(label, F.struct(-F.col("_n"), F.col("_first")))
    return counted.groupBy(*keys).agg(best.alias(label), F.max("_n").alias("hits"), F.sum("_n").alias("n"))


def majority_hits(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``hits, n``: how many rows a guess of the most frequent label by key gets right."""
    counted = rows.groupBy(*keys, label).agg(F.count("*").alias("_n"))
    best = counted.groupBy(*keys).agg(F.max("_n").alias("_best"), F.sum("_n").alias("_all"))
    return best.agg(F.coalesce(F.sum("_best"), F.lit(0)).alias("hits"), F.coalesce(F.sum("_all"), F.lit(0)).alias("n"))


def train_test_majority(rows: DataFrame, *, feature: str, label: str, split_key: str, order: str) -> DataFrame:
    """``hits, unseen, test_count, support, unique_label_count`` of a majority guess learned on half the streams.

    Streams are split by the parity of a hash; if that leaves one side empty,
    rows are split in the middle of their order. Features that training did not
    have get the overall majority.
    """
    halves = rows.withColumn("_half", hash_bucket(F.col(split_key).cast("string"), 2))
    sides = halves.agg(F.count_if(F.col("_half") == 0).alias("a"), F.count_if(F.col("_half") == 1).alias("b")).first()
    if sides.a and sides.b:
        half = F.col("_half")
    elif sides.a + sides.b == 1:
        half = F.lit(2)
    else:  # few streams, all with one hash: only here rows are numbered through
        half = (F.row_number().over(W.orderBy(order)) > (sides.a + sides.b) // 2).cast("int")
    halves = halves.withColumn("_side", half)
    train, test = halves.where("_side IN (0, 2)"), halves.where("_side IN (1, 2)")
    by_feature = majority(train, [feature], label, order).select(F.col(feature).alias("_f"), F.col(label).alias("_guess"))
    overall = train.groupBy(label).agg(F.count("*").alias("_c"), F.min(order).alias("_first")).agg(F.min_by(label, F.struct(-F.col("_c"), F.col("_first"))).alias("_overall"))
    guessed = test.join(by_feature, test[feature].eqNullSafe(F.col("_f")), "left").crossJoin(F.broadcast(overall))
    hits = guessed.agg(F.count_if(F.coalesce("_guess", "_overall") == F.col(label)).alias("hits"), F.count_if(F.col("_guess").isNull()).alias("unseen"), F.count("*").alias("test_count"))
    return hits.crossJoin(rows.agg(F.count("*").alias("support"), F.count_distinct(label).alias("unique_label_count")))


def dominance(rows: DataFrame, *, event: str = "event", action: str = "action", order: str = "ord") -> DataFrame:
    """Each event's most frequent action, and how often it is that."""
    return majority(rows, [event], action, order).select(event, F.col("n").alias("count"), F.col(action).alias("dominant_action"), F.col("hits").alias("dominant_action_count"))


def unique_sequences(rows: DataFrame, *, group: str, stream: str, position: str, event: str) -> DataFrame:
    """``group, sequences``: how many different event sequences the streams of a group have."""
    told = rows.groupBy(stream).agg(F.min(group).alias(group), F.array_sort(F.collect_list(F.struct(position, event))).alias("_told"))
    return told.groupBy(group).agg(F.count_distinct(F.transform("_told", lambda x: x[event])).alias("sequences"))


def string_concentration(rows: DataFrame, *, text: str, event: str) -> DataFrame:
    """``text, n, events``: how often a string occurs, and with how many events."""
    return rows.groupBy(text).agg(F.count("*").alias("n"), F.count_distinct(event).alias("events"), F.min(event).alias("event"))


def _types(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(placeholders(text), lambda p: F.substring(p, F.lit(9), F.length(p) - 9))))


def _words(text: Column, words) -> Column:
    return F.filter(F.array(*[F.when(text.contains(w), w) for w in words]), lambda x: x.isNotNull())


def surface_feature(window: Column, position: Column, speaker: Column) -> Column:
    """What a window looks like from outside, as a group key."""
    text = F.array_join(F.transform(window, lambda t: F.coalesce(t["utterance"], F.lit(""))), " ")
    current = F.coalesce(F.try_element_at(window, F.lit(-1))["utterance"], F.lit(""))
    bucket = F.least(F.floor(F.length(current) / 18), F.lit(5)).cast("int")
    return F.struct(position.alias("position"), speaker.alias("speaker"), _types(text).alias("types"), _types(current).alias("own_types"), _words(text, SURFACE_WORDS).alias("words"), _words(current, SURFACE_WORDS).alias("own_words"), bucket.alias("length"), F.size(window).alias("turns"))


def action_feature(window: Column, position: Column, speaker: Column) -> Column:
    current = F.coalesce(F.try_element_at(window, F.lit(-1))["utterance"], F.lit(""))
    cues = F.filter(F.array(*[F.when(contains_any(current, words), name) for name, words in ACTION_CUES.items()]), lambda x: x.isNotNull())
    return F.struct(position.alias("position"), speaker.alias("speaker"), _types(current).alias("own_types"), cues.alias("cues"))


def repeated_nouns(public: DataFrame) -> DataFrame:
    """The first turn of each window that says a noun twice in a row."""
    hit = F.get(F.filter("input.dialogue_window", lambda t: t["utterance"].rlike(REPEATED_NOUN)), 0)
    rows = public.select("benchmark_id", hit.alias("_t")).where("_t IS NOT NULL")
    return rows.select("benchmark_id", F.col("_t.turn_id").alias("turn_id"), F.regexp_extract("_t.utterance", REPEATED_NOUN, 0).alias("artifact"), F.col("_t.utterance").alias("utterance"))


def joined(public: DataFrame, manifest: DataFrame, gold: DataFrame) -> DataFrame:
    """Gold rows with what manifest and public item add; ``ord``: the order of the gold ids."""
    p = public.select("benchmark_id", F.col("input.dialogue_window").alias("window"), F.col("stream_position").alias("_pp"))
    m = manifest.select("benchmark_id", F.col("stream_position").alias("_mp"), "current_speaker", "stream_profile", "trajectory_variant", F.col("is_fallback_turn").alias("_mf"))
    rows = gold.join(m, "benchmark_id", "left").join(p, "benchmark_id", "left")
    rows = rows.withColumn("position", F.coalesce(F.nullif("_mp", F.lit(0)), "_pp", F.lit(0))).withColumn("profile", F.coalesce(F.nullif("stream_profile", F.lit("")), F.lit("unknown")))
    last = F.try_element_at("window", F.lit(-1))
    rows = rows.withColumn("text", F.coalesce(last["utterance"], F.lit(""))).withColumn("fallback", F.coalesce("is_fallback_turn", F.lit(False)) | F.coalesce("_mf", F.lit(False)))
    speaker = F.coalesce(F.nullif("current_speaker", F.lit("")), last["speaker"], F.lit(""))
    rows = rows.withColumn("surface_feature", surface_feature(F.col("window"), F.col("position"), speaker)).withColumn("action_feature", action_feature(F.col("window"), F.col("position"), speaker))
    return rows.withColumn("artifact", utterance_artifact(F.col("text"))).withColumn("leaks", leakage_terms(F.col("text"))).drop("_pp", "_mp", "_mf", "window", "is_fallback_turn")


def _models(rows: DataFrame) -> DataFrame:
    """``model, feature, label, side, ord``: what each row says to each of the majority models; a row of ``joined`` with ``ord``."""
    told = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    of = lambda model, feature, label: F.struct(model.alias("model") if isinstance(model, Column) else F.lit(model).alias("model"), feature.cast("string").alias("feature"), label.cast("string").alias("label"))
    varied = ~F.col("fallback") & ~F.coalesce("trajectory_variant", F.lit("")).isin("", "canonical")
    nothing, one = F.lit(None).cast("string"), F.lit("")
    models = [
        of("profile_position", told(F.struct("profile", "position")), F.col("event")), of("position", F.col("position"), F.col("event")), of(F.when(F.col("fallback"), "fallback_text").otherwise("normal_text"), F.col("text"), F.col("event")), of("dominance", F.col("event"), F.col("action")),
        of(F.concat(F.lit("branch "), F.col("event")), told(F.col("action_feature")), F.col("action")), F.when(varied, of("variant", told(F.col("surface_feature")), F.col("trajectory_variant"))), of("rows", one, nothing), F.when(F.col("fallback"), of("fallback", one, nothing)),
        F.when(F.col("artifact").isNotNull(), of(F.concat(F.lit("artifact "), F.col("artifact")), one, nothing)), F.when(F.size("leaks") > 0, of("leaks", one, nothing)),
    ]
    long = rows.select(F.inline(F.filter(F.array(*models), lambda m: m.isNotNull())), hash_bucket(F.col("stream_id").cast("string"), 2).alias("side"), "ord")
    return long


def model_figures(rows: DataFrame) -> DataFrame:
    """``model, feature, n, hits, features, labels, best, ...``: every majority model of the report, from one pass over joined rows.

    ``hits``: rows that the most frequent label of their feature gets right; ``repeated``: the features that several rows have, with their rows and hits; ``single``: those of five rows or more that
    have one label. ``test_count``, ``test_hits`` and ``unseen`` are of rows of the one half of streams, guessed from the other half; a feature
    that it lacks gets its most frequent label. ``sides``: how many rows each half has. Only ``dominance`` has a row a feature.
    """
    at = F.col("ord")
    train, test = F.col("side") == 0, F.col("side") == 1
    each = _models(rows).groupBy("model", "feature", "label").agg(F.count("*").alias("n"), F.count_if(train).alias("train"), F.count_if(test).alias("test"), F.min(at).alias("first"), F.min(F.when(train, at)).alias("first_train"))
    learned = F.when(F.col("train") > 0, F.struct(-F.col("train"), F.col("first_train")))
    overall = each.groupBy("model", "label").agg(F.sum("train").alias("train"), F.min("first_train").alias("first_train")).groupBy("model").agg(F.min_by("label", F.when(F.col("train") > 0, F.struct(-F.col("train"), F.col("first_train")))).alias("_usual"))
    # A feature has few labels: events, actions or variants.
    by = each.groupBy("model", "feature").agg(
        F.sum("n").alias("n"), F.max("n").alias("hits"), F.count("*").alias("labels"), F.min_by("label", F.struct(-F.col("n"), F.col("first"))).alias("best"), F.sum("train").alias("_train"), F.sum("test").alias("_test"),
        F.min_by(F.struct("label", "test"), learned).alias("_guess"), F.collect_list(F.when(F.col("test") > 0, F.struct("label", "test"))).alias("_tests"), F.collect_set("label").alias("_labels"),
    )
    right = F.when(F.col("_train") > 0, F.col("_guess.test")).otherwise(F.aggregate(F.filter("_tests", lambda t: t["label"] == F.col("_usual")), F.lit(0).cast("bigint"), lambda a, t: a + t["test"]))
    several = F.col("n") >= 2
    placed = by.join(overall, "model").withColumn("_right", right).withColumn("feature", F.when(F.col("model") == "dominance", F.col("feature")).otherwise(""))
    return placed.groupBy("model", "feature").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.count("*").alias("features"), F.size(F.array_distinct(F.flatten(F.collect_set("_labels")))).alias("labels"), F.min("best").alias("best"),
        F.count_if(several).alias("repeated"), F.coalesce(F.sum(F.when(several, F.col("n"))), F.lit(0)).alias("repeated_n"), F.coalesce(F.sum(F.when(several, F.col("hits"))), F.lit(0)).alias("repeated_hits"), F.count_if((F.col("n") >= 5) & (F.col("labels") == 1)).alias("single"),
        F.sum("_train").alias("train_count"), F.sum("_test").alias("test_count"), F.sum("_right").alias("test_hits"), F.coalesce(F.sum(F.when(F.col("_train") == 0, F.col("_test"))), F.lit(0)).alias("unseen"),
    )


#: Lists of turns: how they are called, and which artifact or, for none, leak is in them.
_SHOWN = {"placeholder_only_turn_examples": "placeholder_only_utterance", "very_short_turn_examples": "very_short_utterance", "instruction_residue_turn_examples": "instruction_residue_in_utterance", "category_leakage_examples": None}


def report_lists(rows: DataFrame, limit: int = 20) -> DataFrame:
    """Top-k reports: ``list, place, benchmark_id, stream_id, position, utterance, event, count`` of the strings and turns that the report shows, all lists in one pass."""
    none = lambda kind: F.lit(None).cast(kind)
    strings = rows.groupBy("fallback", "text").agg(F.count("*").alias("count"), F.count_distinct("event").alias("_events"), F.min("event").alias("event"), F.min("ord").alias("_first"))
    kind = F.when(F.col("fallback"), "fallback").otherwise("non_fallback")
    often = F.struct((-F.col("count")).alias("n"), F.col("_first").alias("first"), F.lit("").alias("text"))
    single = F.struct((-F.col("count")).alias("n"), F.lit(None).cast(rows.schema["ord"].dataType).alias("first"), F.col("text").alias("text"))
    lists = F.array(F.struct(F.concat(F.lit("top_"), kind, F.lit("_strings")).alias("list"), often.alias("_by")), F.when((F.col("count") >= 5) & (F.col("_events") == 1), F.struct(F.concat(F.lit("high_count_single_event_"), kind, F.lit("_strings")).alias("list"), single.alias("_by"))))
    told = strings.select(F.inline(F.filter(lists, lambda x: x.isNotNull())), none("string").alias("benchmark_id"), none("string").alias("stream_id"), none("int").alias("position"), F.col("text").alias("utterance"), "event", "count")
    shown = F.filter(F.array(*[F.when(F.size("leaks") > 0 if a is None else F.col("artifact") == a, name) for name, a in _SHOWN.items()]), lambda x: x.isNotNull())
    place = F.struct(F.lit(0).cast("bigint").alias("n"), F.col("ord").alias("first"), F.lit("").alias("text"))
    turns = rows.select(F.explode(shown).alias("list"), place.alias("_by"), "benchmark_id", "stream_id", F.col("position").cast("int").alias("position"), F.col("text").alias("utterance"), none("string").alias("event"), none("bigint").alias("count"))
    return told.unionByName(turns).withColumn("place", F.row_number().over(W.partitionBy("list").orderBy("_by"))).where(F.col("place") <= limit).drop("_by")


def shortcut_report(public: DataFrame, manifest: DataFrame, gold: DataFrame, rejected: DataFrame, *, order: str | None = None) -> dict[str, Any]:
    """The report's figures and its gates: one query for all counts, one for all lists."""
    rows = joined(public, manifest, gold)
    rows = rows.withColumn("ord", F.struct("stream_id", "position", "benchmark_id") if order is None else F.col(order))
    rows = rows.persist()
    try:
        return _report(rows, public, rejected)
    finally:
        rows.unpersist()


def _report(rows: DataFrame, public: DataFrame, rejected: DataFrame) -> dict[str, Any]:
    names = ("n", "hits", "features", "labels", "best", "repeated", "repeated_n", "repeated_hits", "single", "train_count", "test_count", "test_hits", "unseen")
    plain = lambda df, model, feature, n: df.select(model.alias("model"), feature.alias("feature"), n.cast("bigint").alias("n"), *[F.lit(None).cast("string" if c == "best" else "bigint").alias(c) for c in names[1:]])
    sequences_ = unique_sequences(rows, group="profile", stream="stream_id", position="position", event="event")
    counted = model_figures(rows).select("model", "feature", *[F.col(c).cast("string" if c == "best" else "bigint").alias(c) for c in names])
    counted = counted.unionByName(plain(sequences_, F.lit("sequences"), F.col("profile"), F.col("sequences")))
    for df, name in ((repeated_nouns(public), "nouns"), (rejected, "rejected")):
        counted = counted.unionByName(plain(df.agg(F.count("*").alias("n")), F.lit(name), F.lit(""), F.col("n")))
    found: dict[str, dict[str, Any]] = {}
    for r in counted.collect():
        found.setdefault(r.model, {})[r.feature] = r.asDict()
    zero = dict.fromkeys(names, 0)
    one = lambda model: found.get(model, {}).get("", zero)
    ratio = lambda hits, n: hits / n if n else 0.0
    accuracy = lambda model: ratio(one(model)["hits"], one(model)["n"])

    def model(name: str, where: str | Column, feature: str, label: str) -> dict[str, Any]:
        r = one(name)
        if r["n"] and not (r["train_count"] and r["test_count"]):  # few streams, all with one hash: rows are split in the middle instead
            r = (train_test_majority(rows.where(where), feature=feature, label=label, split_key="stream_id", order="ord").first() or zero).asDict()
            r = {"n": r["support"], "labels": r["unique_label_count"], "test_count": r["test_count"], "test_hits": r["hits"], "unseen": r["unseen"]}
        return {"test_count": r["test_count"], "support": r["n"], "unique_label_count": r["labels"], "accuracy": ratio(r["test_hits"], r["test_count"]), "unseen_feature_rate": ratio(r["unseen"], r["test_count"])}

    n, n_fallback = one("rows")["n"], one("fallback")["n"]
    sequences = {k: r["n"] for k, r in found.get("sequences", {}).items()}
    dominant = {k: {"event": k, "count": r["n"], "dominant_action": r["best"], "dominant_action_count": r["hits"]} for k, r in sorted(found.get("dominance", {}).items())}
    ratios = [r["dominant_action_count"] / r["count"] for r in dominant.values()]
    branching = [k for k, r in sorted(found.get("dominance", {}).items()) if r["labels"] >= 2 and r["n"] >= 30]
    branches = {event: model(f"branch {event}", F.col("event") == event, "action_feature", "action") for event in branching}
    weak = [event for event, r in branches.items() if r["test_count"] >= 10 and r["accuracy"] < 0.60]
    varied = model("variant", "NOT fallback AND coalesce(trajectory_variant, '') NOT IN ('', 'canonical')", "surface_feature", "trajectory_variant")
    fallback, normal = one("fallback_text"), one("normal_text")
    artifacts = {k.removeprefix("artifact "): v[""]["n"] for k, v in found.items() if k.startswith("artifact ")}
    leaks, nouns, n_rejected = one("leaks")["n"], one("nouns")["n"], one("rejected")["n"]
    common: dict[str, list] = {name: [] for name in ("top_fallback_strings", "top_non_fallback_strings", "high_count_single_event_fallback_strings", "high_count_single_event_non_fallback_strings", *_SHOWN)}
    for r in sorted(report_lists(rows).collect(), key=lambda r: r.place):
        if r.list in _SHOWN:
            common[r.list].append({k: r[k] for k in ("benchmark_id", "stream_id", "position", "utterance")})
        else:
            common[r.list].append({"utterance": r.utterance, "count": r["count"]} | ({} if r.list.startswith("top_") else {"event": r.event}))
    profile_position, least_sequences = accuracy("profile_position"), min(sequences.values(), default=0)
    repeated_accuracy, some_fallback, rate = ratio(fallback["repeated_hits"], fallback["repeated_n"]), 0 < n_fallback < n, n_fallback / n if n else 0.0
    varied_applies, repeated_applies = varied["support"] >= 200 and varied["unique_label_count"] >= 2, some_fallback and fallback["repeated_n"] >= 20
    gates = {
        "min_profile_unique_event_sequences_at_least_4": least_sequences >= 4, "profile_position_event_accuracy_below_0_90": profile_position < 0.90, "event_action_not_fully_deterministic": not all(r == 1.0 for r in ratios),
        "max_event_action_dominance_below_0_85": max(ratios, default=0.0) < 0.85, "low_action_branch_signal_events_is_empty": not weak, "variant_surface_event_accuracy_below_0_45_or_skipped": not varied_applies or varied["accuracy"] < 0.45,
        "fallback_turn_rate_below_0_08_or_skipped": not some_fallback or rate < 0.08, "repeated_fallback_string_event_accuracy_below_0_80_or_skipped": not repeated_applies or repeated_accuracy < 0.80,
        "high_count_single_event_fallback_strings_is_zero_or_skipped": not some_fallback or fallback["single"] == 0, "placeholder_only_turn_count_is_zero": not artifacts.get("placeholder_only_utterance"),
        "very_short_turn_count_is_zero": not artifacts.get("very_short_utterance"), "instruction_residue_turn_count_is_zero": not artifacts.get("instruction_residue_in_utterance"),
        "high_count_single_event_non_fallback_strings_is_zero": normal["single"] == 0, "repeated_noun_artifact_count_is_zero": nouns == 0, "rejected_count_is_zero": n_rejected == 0,
    }
    return {
        "profile_position_majority_event_accuracy": profile_position, "position_only_majority_event_accuracy": accuracy("position"), "profile_unique_event_sequence_counts": dict(sorted(sequences.items())),
        "min_profile_unique_event_sequences": least_sequences, "max_event_action_dominance": max(ratios, default=0.0), "event_action_dominance": dominant, "action_branch_surface_accuracy_by_event": branches,
        "low_action_branch_signal_events": weak, "variant_surface_model": varied, "variant_surface_gate_applicable": varied_applies, "fallback_turn_count": n_fallback, "fallback_turn_rate": rate,
        "fallback_quality_gate_applicable": some_fallback, "fallback_string_majority_event_accuracy": accuracy("fallback_text"), "fallback_unique_string_count": fallback["features"],
        "repeated_fallback_pair_count": fallback["repeated_n"], "repeated_fallback_string_majority_event_accuracy": repeated_accuracy, "repeated_fallback_gate_applicable": repeated_applies,
        "high_count_single_event_fallback_string_count": fallback["single"], "repeated_non_fallback_string_count": normal["repeated"], "repeated_non_fallback_pair_count": normal["repeated_n"],
        "high_count_single_event_non_fallback_string_count": normal["single"], "placeholder_only_turn_count": artifacts.get("placeholder_only_utterance", 0), "very_short_turn_count": artifacts.get("very_short_utterance", 0),
        "instruction_residue_turn_count": artifacts.get("instruction_residue_in_utterance", 0), "category_leakage_turn_count": leaks, "repeated_noun_artifact_count": nouns, "gate_checks": gates, "shortcut_gate_passed": all(gates.values()),
    } | common


def top_strings(rows: DataFrame, *, text: str, limit: int = 20) -> DataFrame:
    """A top-k report: the most frequent strings, equals by text."""
    return rows.groupBy(text).agg(F.count("*").alias("count")).orderBy(F.desc("count"), text).limit(limit)


def combined(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
