"""Facts about whole records, from their array of turns; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions import labels as L
from talkgrain.functions.text import contains_any, duplicate_key, has_hangul, has_unknown_bracket, let


def speaker_texts(dialogue: Column, speaker: str) -> Column:
    said = F.filter(dialogue, lambda t: t["speaker"] == speaker)
    return F.transform(said, lambda t: F.coalesce(t["utterance"], F.lit("")))


def role_order_valid(dialogue: Column) -> Column:
    """Attacker first, then in turn."""
    ordered = F.transform(dialogue, lambda t, k: F.coalesce(t["speaker"] == F.when(k % 2 == 0, "attacker").otherwise("victim"), F.lit(False)))
    return F.forall(ordered, lambda ok: ok)


def _keys(dialogue: Column) -> Column:
    return F.transform(dialogue, lambda t: duplicate_key(F.coalesce(t["utterance"], F.lit(""))))


def no_duplicate_turns(dialogue: Column) -> Column:
    return F.size(F.array_distinct(_keys(dialogue))) == F.size(dialogue)


def repeats_a_turn(text: Column, dialogue: Column) -> Column:
    return F.array_contains(_keys(dialogue), duplicate_key(text))


def no_refusal_leak(dialogue: Column) -> Column:
    return ~F.exists(dialogue, lambda t: F.coalesce(contains_any(t["utterance"], K.REFUSAL_MARKERS), F.lit(False)))


def attacker_risks(dialogue: Column) -> Column:
    """The distinct risks of the attacker's turns, sorted; blank, absent and fallback risks don't count."""
    risks = F.transform(F.filter(dialogue, lambda t: t["speaker"] == "attacker"), lambda t: t["risk_signal"])
    return F.array_sort(F.array_distinct(F.filter(risks, lambda r: r.isNotNull() & ~r.isin("", "generation_fallback"))))


def label_consistent(label: Column, dialogue: Column, risk_labels: Column) -> Column:
    seen = attacker_risks(dialogue)
    return F.when(label == "attack", F.arrays_overlap(seen, risk_labels)).when(label == "benign", F.size(seen) == 0).otherwise(True)


def language_consistent(dialogue: Column, locale: Column) -> Column:
    korean = (F.size(dialogue) > 0) & F.forall(dialogue, lambda t: F.coalesce(has_hangul(t["utterance"]), F.lit(False)))
    return F.when(locale == "ko-KR", korean).otherwise(True)


def should_end(dialogue: Column) -> Column:
    last = F.try_element_at(dialogue, F.lit(-1))
    done = last["risk_signal"].isin("victim_resistance", "asset_disclosure") | last["utterance"].contains("종료")
    return F.coalesce((F.size(dialogue) >= 6) & (last["speaker"] == "victim") & done, F.lit(False))


def up_to_end(dialogue: Column) -> Column:
    """The turns up to the first at which the dialogue should end."""
    stops = F.transform(dialogue, lambda _, k: should_end(F.slice(dialogue, F.lit(1), k + 1)))
    first = F.array_position(stops, True)
    return F.when(first > 0, F.slice(dialogue, F.lit(1), first.cast("int"))).otherwise(dialogue)


def safety_masks(dialogue: Column) -> Column:
    return F.flatten(F.transform(dialogue, lambda t: t["masked_items"]))


def has_bracket(dialogue: Column) -> Column:
    return F.exists(dialogue, lambda t: F.coalesce(has_unknown_bracket(t["utterance"]), F.lit(False)))


def outcome(dialogue: Column) -> Column:
    """From what the victim's turns do, each looked at once."""

    def seen(u: Column) -> Column:
        partial = L.partly_complies(u) & ~L.only_refuses_compliance(u)
        return F.struct(partial.alias("partial"), (partial & ~L.complies_on_condition(u) & L.complies_unconditionally(u)).alias("open"), L.is_compromise(u).alias("yields"), (L.refuses(u) | contains_any(u, K.OUTCOME_DEFENSE_KEYWORDS)).alias("defends"))

    return let(
        F.transform(speaker_texts(dialogue, "victim"), seen),
        lambda said: (
            F.when(F.exists(said, lambda s: s["open"]), "compromised")
            .when(F.exists(said, lambda s: s["partial"]), "inconclusive")
            .when(F.exists(said, lambda s: s["yields"]), "compromised")
            .when(F.exists(said, lambda s: s["defends"]), "defended_success")
            .otherwise("inconclusive")
        ),
    )


def compromised_assets(dialogue: Column) -> Column:
    """Of a compromised record; empty for other outcomes."""
    turns = F.filter(dialogue, lambda t: (t["speaker"] == "victim") & L.is_compromise(F.coalesce(t["utterance"], F.lit(""))))

    def given(t: Column) -> Column:
        items = F.filter(F.coalesce(t["masked_items"], F.array()), lambda m: (m["label"] != "") & L.gives_up(t["utterance"], m["placeholder"]))
        return F.transform(items, lambda m: F.concat(F.lit("masked_"), m["label"]))

    assets = F.array_sort(F.array_distinct(F.flatten(F.transform(turns, given))))
    known = F.when(F.size(assets) > 0, assets).when(F.size(turns) > 0, F.array(F.lit("unknown_masked_asset"))).otherwise(F.array().cast("array<string>"))
    return F.when(outcome(dialogue) == "compromised", known).otherwise(F.array().cast("array<string>"))


def risk_labels(dialogue: Column, defaults: Column) -> Column:
    return F.array_sort(F.array_union(defaults, attacker_risks(dialogue)))


def with_facts(records: DataFrame) -> DataFrame:
    """Adds ``facts``: what the quality checks of a record are computed from."""
    d = F.col("dialogue")
    facts = F.struct(
        F.size(d).alias("turn_count"), role_order_valid(d).alias("role_order_valid"), no_duplicate_turns(d).alias("no_duplicate_turns"), no_refusal_leak(d).alias("no_refusal_leak"),
        label_consistent(F.col("label"), d, F.col("risk_labels")).alias("label_consistent"), language_consistent(d, F.col("locale")).alias("language_consistent"),
        outcome(d).alias("outcome"), compromised_assets(d).alias("compromised_assets"), attacker_risks(d).alias("attacker_risks"),
    )
    return records.withColumn("facts", facts)


def turns(records: DataFrame) -> DataFrame:
    """One row a turn: the record's columns but its dialogue, ``place`` (from 0) and the turn's fields."""
    others = [c for c in records.columns if c != "dialogue"]
    return records.select(*others, F.posexplode("dialogue").alias("place", "turn")).select(*others, "place", "turn.*")
