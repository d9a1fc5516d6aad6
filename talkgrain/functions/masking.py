"""Masking of sensitive values, on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain.constants import ALIAS_NAMES, ALIAS_PARTS, ALIASES, BRACKET_COMPANY_PARTS, BRACKET_NAMES, FORBIDDEN_TERMS, MASKS, PLACEHOLDER, REVIEWED_PLACEHOLDERS, STANDARD_PLACEHOLDERS
from talkgrain.functions.text import contains_any, let

_LABELS = {placeholder: label for label, placeholder, _ in MASKS}


def alias_of(placeholder: Column) -> Column:
    """The placeholder that a masked token's name stands for; null for known ones and for names that say nothing."""
    token = F.substring(placeholder, F.lit(9), F.length(placeholder) - 9)
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    out = F.when(placeholder.isin(*STANDARD_PLACEHOLDERS, *REVIEWED_PLACEHOLDERS), F.lit(None).cast("string")).when(F.try_element_at(known, placeholder).isNotNull(), F.try_element_at(known, placeholder))
    out = out.when(~placeholder.startswith("[MASKED_") | ~placeholder.endswith("]"), F.lit(None).cast("string"))
    for name, target in ALIAS_NAMES.items():
        out = out.when(token == name, target)
    for parts, target in ALIAS_PARTS:
        out = out.when(contains_any(token, parts), target)
    return out


def bracket_token(token: Column) -> Column:
    """The placeholder for a lower-case name in brackets."""
    named = alias_of(F.concat(F.lit("[MASKED_"), F.upper(token), F.lit("]")))
    return F.coalesce(named, F.when(contains_any(token, BRACKET_COMPANY_PARTS), "[MASKED_COMPANY]").when(token.contains("name"), "[MASKED_NAME]").otherwise("[MASKED_CASE_REFERENCE]"))


def _rewritten(text: Column, tokens: Column, target) -> Column:
    """Replace each distinct token; brackets keep one token from being a part of another."""
    return F.aggregate(F.array_distinct(tokens), text, lambda acc, token: F.replace(acc, token, target(token)))


def normalise_aliases(text: Column) -> Column:
    """Exact aliases, names in brackets, lower-case tokens, then names of masked tokens."""
    return F.when(text.contains("["), _normalised(text)).otherwise(text)


def _normalised(text: Column) -> Column:
    text = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), ALIASES.items(), text)
    text = F.regexp_replace(text, r"(?iu)\[(?:" + "|".join(BRACKET_NAMES) + r")\]", "[MASKED_NAME]")

    def tokens(pattern: str):
        return lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))

    lower, masked = tokens(r"\[[a-z][a-z0-9_]{1,80}\]"), tokens(PLACEHOLDER)
    text = let(text, lambda t: _rewritten(t, lower(t), lambda x: bracket_token(F.substring(x, F.lit(2), F.length(x) - 2))))
    return let(text, lambda t: _rewritten(t, masked(t), lambda x: F.coalesce(alias_of(x), x)))


def _item(label: Column | str, placeholder: Column | str) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(label).alias("label"), as_column(placeholder).alias("placeholder"))


def mask_text(text: Column) -> Column:
    """``struct(text, masked_items)``: the patterns apply in turn, each to what the one before left.

    Placeholders that are in the text already come first among the items; the
    values themselves are never kept.
    """
    labels = F.create_map(*[F.lit(x) for pair in _LABELS.items() for x in pair])

    def present(t: Column) -> Column:
        standard = F.filter(F.regexp_extract_all(t, F.lit(PLACEHOLDER), F.lit(0)), lambda p: p.isin(*STANDARD_PLACEHOLDERS))
        return F.struct(t.alias("text"), F.transform(standard, lambda p: _item(F.element_at(labels, p), p)).alias("masked_items"))

    state = let(normalise_aliases(text), present)
    for mask in MASKS:
        state = let(state, _applied(*mask))
    return state


#: What a text must hold for a pattern to match: a cheap test before a costly one. Words are looked for in lower case.
_SIGNS = {
    "url": ("://", "www."), "rrn": ("-",), "otp": ("otp", "인증번호", "보안코드", "verification code"), "phone": ("01",), "email": ("@",), "account": ("-",),
    "credential": ("password", "passwd", "비밀번호", "pin"),
}


def _applied(label: str, placeholder: str, pattern: str):
    """One pattern's step: its items, and the text without its values."""

    def step(state: Column) -> Column:
        found = F.array_repeat(_item(label, placeholder), F.regexp_count(state["text"], F.lit(pattern)))
        masked = F.struct(F.regexp_replace(state["text"], pattern, placeholder).alias("text"), F.concat(state["masked_items"], found).alias("masked_items"))
        return F.when(contains_any(F.lower(state["text"]), _SIGNS[label]), masked).otherwise(state)

    return step


def residual_labels(text: Column) -> Column:
    """Labels of patterns that still match, in their order."""
    return F.filter(F.array(*[F.when(text.rlike(pattern), label) for label, _, pattern in MASKS]), lambda x: x.isNotNull())


def is_residual_clean(text: Column) -> Column:
    return F.size(residual_labels(text)) == 0


def has_forbidden_detail(text: Column) -> Column:
    return contains_any(text, FORBIDDEN_TERMS)


def exported_masks(items: Column) -> Column:
    """Label and placeholder of each item, nothing else."""
    return F.transform(items, lambda m: _item(m["label"], m["placeholder"]))
