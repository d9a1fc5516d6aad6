"""String columns: cleaning, normal forms and what an utterance holds.

Patterns carry ``(?U)``, so that white space and word borders are Unicode's.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain.constants import LEAKAGE_TERMS, PLACEHOLDER, RESIDUE_MARKERS, SHORT_UTTERANCES, STANDARD_PLACEHOLDERS, UNKNOWN_BRACKET

# What an empty answer becomes, pairs of quotes, role names and stage directions before an utterance, nouns that must not be said twice in a row.
DEFAULT_UTTERANCE = "공식 경로로 다시 확인하겠습니다."
QUOTES = (('"', '"'), ("'", "'"), ("“", "”"), ("‘", "’"))
_ROLE = r"(?iU)^\s*(?:공격자|피해자|attacker|victim|assistant)\s*[:：-]\s*"
_STAGE = r"(?U)^\s*\[(?!MASKED_)[^\]]{1,80}\]\s*"
#: What Unicode, and the separators of ASCII, count as white space.
WHITE_SPACE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
NOUNS = "알림|안내|확인|처리|경로|절차|요청"
REPEATED_NOUN = rf"(?U)({NOUNS})(\s+\1)+"


def let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), 0)


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """Whether one of ``terms`` occurs; one condition, no regular expression."""
    found = F.lit(False)
    for term in terms:
        found = found | text.contains(term)
    return found


def stripped(text: Column) -> Column:
    """Without white space of any kind at its ends; only the ends are looked at."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def _unquoted(text: Column) -> Column:
    out = F
    for left, right in QUOTES:
        fits = text.startswith(left) & text.endswith(right) & (F.length(text) >= 2)
        inner = stripped(F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0))))
        out = out.when(fits, inner)
    return out.otherwise(text)


def clean_model_utterance(text: Column) -> Column:
    """The first line of a model's answer, without thoughts, fences, role, stage direction and quotes."""
    text = stripped(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""))
    text = stripped(F.replace(text, F.lit("```"), F.lit("")))
    unframed = lambda t: stripped(F.regexp_replace(stripped(F.regexp_replace(t, _ROLE, "")), _STAGE, ""))
    text = _unquoted(unframed(text))
    lines = F.filter(F.transform(F.split(text, r"\R"), stripped), lambda line: line != "")
    text = F.when(text.contains("\n"), unframed(F.coalesce(F.get(lines, 0), F.lit("")))).otherwise(text)
    return F.when(F.coalesce(text, F.lit("")) == "", DEFAULT_UTTERANCE).otherwise(text)


def clean_utterance(text: Column) -> Column:
    """The planner's shorter cleaning: quotes, role, white space, repeated nouns."""
    text = F.regexp_replace(stripped(text), "^[\"'“”‘’]+|[\"'“”‘’]+$", "")
    text = F.regexp_replace(text, _ROLE, "")
    return F.regexp_replace(stripped(F.regexp_replace(text, r"(?U)\s+", " ")), REPEATED_NOUN, "$1")


def duplicate_key(text: Column) -> Column:
    """Lower case without white space: utterances with one key are duplicates."""
    return F.regexp_replace(F.lower(text), r"(?U)\s+", "")


def truncated(text: Column, limit: int = 160) -> Column:
    text = stripped(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))


def placeholders(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(0))


def has_placeholder(text: Column) -> Column:
    return text.rlike(PLACEHOLDER)


def nonstandard_placeholders(text: Column) -> Column:
    return F.filter(placeholders(text), lambda p: ~p.isin(*STANDARD_PLACEHOLDERS))


def surface_text(text: Column, surface: str) -> Column:
    if surface == "neutral_mask":
        return F.regexp_replace(text, PLACEHOLDER, "[MASKED_VALUE]")
    if surface == "placeholder_ablated":
        return F.regexp_replace(text, PLACEHOLDER, "[MASKED]")
    return text


def sentences(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(r"[^.!?\n。！？]+[.!?。！？]?"), F.lit(0)), stripped)
    found = F.filter(found, lambda s: s != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(stripped(text)))


#: A sentence that is not blank: white space and a mark, or anything else up to a mark or a line's end. White space without either is tried once, not from each of its characters.
_BLANK = r"[\x09\x0B-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_SENTENCE = rf"(?<!{_BLANK})(?:{_BLANK}++[.!?。！？]|{_BLANK}*+[^.!?\n。！？{_BLANK[1:-1]}][^.!?\n。！？]*+[.!?。！？]?)"


def sentence_count(text: Column) -> Column:
    """The size of ``sentences``, without making them."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(_SENTENCE)))


def joined_sentences(parts: Column) -> Column:
    return stripped(F.array_join(F.filter(F.transform(parts, stripped), lambda s: s != ""), " "))


def evidence_sentence(text: Column, keywords: Iterable[str]) -> Column:
    keys = [k for k in keywords if k]
    return F.get(F.filter(sentences(text), lambda s: contains_any(s, keys)), 0)


def is_exact_evidence(evidence: Column, text: Column) -> Column:
    """Whether a text has the evidence, word for word; empty evidence is none."""
    return (stripped(evidence) != "") & text.contains(evidence)


def has_unknown_bracket(text: Column) -> Column:
    return text.rlike(UNKNOWN_BRACKET)


def without_masks(text: Column) -> Column:
    return F.regexp_replace(text, PLACEHOLDER, " ")


def hangul_length(text: Column) -> Column:
    return F.regexp_count(without_masks(text), F.lit("[가-힣]"))


def is_placeholder_only(text: Column) -> Column:
    return ~without_masks(text).rlike("[가-힣A-Za-z0-9]")


def has_hangul(text: Column) -> Column:
    return text.rlike("[가-힣]")


def utterance_artifact(text: Column) -> Column:
    """What is wrong with an utterance's form, or null."""
    return (
        F.when(is_placeholder_only(text), "placeholder_only_utterance")
        .when(contains_any(text, RESIDUE_MARKERS), "instruction_residue_in_utterance")
        .when(contains_any(text, SHORT_UTTERANCES) | (hangul_length(text) < 9), "very_short_utterance")
    )


def leakage_terms(text: Column) -> Column:
    return F.array_sort(F.filter(F.array(*[F.when(text.contains(t), t) for t in LEAKAGE_TERMS]), lambda t: t.isNotNull()))
