"""The strict record contract, on VARIANT: the first violated rule of each record, or null.

Only the raw JSON tells a missing key from a null and a boolean from a number,
so the rules read the VARIANT; each is one condition, and their order is part
of the contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain import constants as K
from talkgrain.functions.text import stripped

_KIND = "coalesce(schema_of_variant(try_variant_get({v}, '{p}', 'variant')), 'MISSING')"


def kind(v: str, path: str = "$") -> str:
    """SQL for the JSON type at a path: STRING, BIGINT, BOOLEAN, ARRAY..., OBJECT..., VOID or MISSING."""
    return _KIND.format(v=v, p=path)


def _is(v: str, path: str, what: str) -> Column:
    return F.expr(f"startswith({kind(v, path)}, '{what}')")


def _text(v: str, path: str) -> Column:
    return F.expr(f"try_variant_get({v}, '{path}', 'string')")


def _keys(v: str) -> str:
    return f"coalesce(json_object_keys(to_json({v})), array())"


def _filled(v: str, path: str) -> Column:
    return _is(v, path, "STRING") & (stripped(_text(v, path)) != "")


def _missing(keys: Column, needed: tuple[str, ...]) -> Column:
    return F.array_sort(F.array_except(F.array(*map(F.lit, needed)), keys))


def _listed(names: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "), F.lit("]"))


def _array(v: str, path: str) -> Column:
    return F.coalesce(F.expr(f"try_variant_get({v}, '{path}', 'array<variant>')"), F.expr("cast(array() as array<variant>)"))


def record_error(raw: str = "raw", *, max_turns: int = 10, risk_labels: tuple[str, ...] | None = None) -> Column:
    """The first violated rule, as text; null for a good record."""
    dialogue, risks = _array(raw, "$.dialogue"), _array(raw, "$.risk_labels")
    keys = F.expr(_keys(raw))
    size = F.size(dialogue)
    absent = _missing(keys, K.RECORD_FIELDS)
    risk_texts = F.transform(risks, lambda r: r.cast("string"))
    rules = [
        F.when(F.size(absent) > 0, F.concat(F.lit("Missing record fields: "), _listed(absent))),
        F.when(~_is(raw, "$.dialogue", "ARRAY") | (size == 0), "dialogue must be a non-empty list"),
        F.when(size > max_turns, f"dialogue exceeds max_turns={max_turns}"),
        F.when(~_is(raw, "$.protected_assets", "ARRAY") | (F.size(_array(raw, "$.protected_assets")) == 0), "protected_assets must be a non-empty list"),
        F.when(~_is(raw, "$.risk_labels", "ARRAY") | (F.size(risks) == 0), "risk_labels must be a non-empty list"),
        F.when(F.exists(risks, lambda r: (F.schema_of_variant(r) != "STRING") | (stripped(r.cast("string")) == "")), "risk_labels entries must be non-empty strings"),
    ]
    if risk_labels is not None:
        unknown = F.array_sort(F.array_distinct(F.filter(risk_texts, lambda r: ~r.isin(*risk_labels))))
        rules.append(F.when(F.size(unknown) > 0, F.concat(F.lit("Unknown risk_labels: "), _listed(unknown))))
    for field, allowed in (("label", K.LABELS), ("outcome", K.OUTCOMES), ("split", K.SPLITS)):
        value = _text(raw, f"$.{field}")
        rules.append(F.when(~F.coalesce(value.isin(*allowed), F.lit(False)), F.concat(F.lit(f"Invalid {field}: "), F.coalesce(value, F.lit("None")))))
    rules.append(F.when(~_is(raw, "$.safety_masks", "ARRAY"), "safety_masks must be a list").otherwise(_mask_error(_array(raw, "$.safety_masks"), F.lit("safety_masks"))))
    context = "$.gen_metadata.environmental_context"
    rules += [F.when(~_is(raw, "$.gen_metadata", "OBJECT"), "gen_metadata must be an object"), F.when(F.expr(f"{kind(raw, context)} <> 'MISSING'") & ~_is(raw, context, "OBJECT"), "gen_metadata.environmental_context must be an object")]
    lacking = F.filter(F.array(*[F.when(F.expr(f"{kind(raw, f'{context}.{f}')} = 'MISSING'"), f) for f in K.CONTEXT_FIELDS]), lambda x: x.isNotNull())
    given = F.expr(f"{kind(raw, context)} <> 'MISSING'")
    rules.append(F.when(given & (F.size(lacking) > 0), F.concat(F.lit("gen_metadata.environmental_context is missing fields: "), _listed(lacking))))
    rules += [F.when(given & ~_filled(raw, f"{context}.{f}"), f"gen_metadata.environmental_context.{f} must be a non-empty string") for f in K.CONTEXT_FIELDS]
    turn_errors = F.filter(F.transform(dialogue, _turn_error), lambda e: e.isNotNull())
    rules.append(F.get(turn_errors, 0))
    checks = "$.quality_checks"
    rules.append(F.when(~_is(raw, checks, "OBJECT"), "quality_checks must be an object"))
    rules += [F.when(F.expr(f"{kind(raw, f'{checks}.{f}')} = 'MISSING'"), f"Missing quality check: {f}") for f in ("turn_count", *K.QUALITY_FLAGS)]
    rules.append(F.when(~_is(raw, f"{checks}.turn_count", "BIGINT"), "quality_checks.turn_count must be an integer"))
    rules.append(F.when(F.expr(f"try_variant_get({raw}, '{checks}.turn_count', 'bigint')") != size, "quality_checks.turn_count must match dialogue length"))
    rules += [F.when(~_is(raw, f"{checks}.{f}", "BOOLEAN"), f"quality_checks.{f} must be a boolean") for f in K.QUALITY_FLAGS]
    return F.coalesce(*rules)


def _get(v: Column, path: str, kind_: str) -> Column:
    return F.try_variant_get(v, path, kind_)


def _mask_error(masks: Column, name: Column) -> Column:
    def one(mask: Column, k: Column) -> Column:
        place = F.concat(name, F.lit("["), k.cast("string"), F.lit("]"))
        keys = F.json_object_keys(F.to_json(mask))
        bad = F.when(~F.schema_of_variant(mask).startswith("OBJECT"), F.concat(place, F.lit(" must be an object"))).when(F.array_contains(keys, "original"), F.concat(name, F.lit(" must not expose original sensitive values")))
        for field in ("label", "placeholder"):
            bad = bad.when(~F.array_contains(keys, field), F.concat(place, F.lit(f" is missing {field}")))
            value = _get(mask, f"$.{field}", "variant")
            blank = ~F.coalesce((F.schema_of_variant(value) == "STRING") & (stripped(value.cast("string")) != ""), F.lit(False))
            bad = bad.when(blank, F.concat(place, F.lit(f".{field} must be a non-empty string")))
        return bad

    return F.get(F.filter(F.transform(masks, one), lambda e: e.isNotNull()), 0)


def _turn_error(turn: Column, k: Column) -> Column:
    place = (k + 1).cast("string")
    absent = _missing(F.coalesce(F.json_object_keys(F.to_json(turn)), F.array()), K.TURN_FIELDS)
    speaker = _get(turn, "$.speaker", "string")
    expected = F.when(k % 2 == 0, "attacker").otherwise("victim")
    number = _get(turn, "$.turn_id", "variant")
    right_number = F.coalesce((F.schema_of_variant(number) == "BIGINT") & (_get(turn, "$.turn_id", "bigint") == k + 1), F.lit(False))
    masks = _get(turn, "$.masked_items", "variant")
    name = F.concat(F.lit("dialogue["), place, F.lit("].masked_items"))
    return (
        F.when(F.size(absent) > 0, F.concat(F.lit("Missing turn fields at "), place, F.lit(": "), _listed(absent)))
        .when(~right_number, F.concat(F.lit("turn_id mismatch at turn "), place))
        .when(~F.coalesce(speaker.isin("attacker", "victim"), F.lit(False)), F.concat(F.lit("Invalid speaker at turn "), place, F.lit(": "), F.coalesce(speaker, F.lit("None"))))
        .when(speaker != expected, F.concat(F.lit("Unexpected speaker order at turn "), place, F.lit(": "), speaker))
        .when(~F.schema_of_variant(masks).startswith("ARRAY"), F.concat(name, F.lit(" must be a list")))
        .otherwise(_mask_error(_get(turn, "$.masked_items", "array<variant>"), name))
    )


def checked(raw: DataFrame, *, max_turns: int = 10, risk_labels: tuple[str, ...] | None = None) -> DataFrame:
    """All rows with their ``error``, which comes out of a generator, so that filters on it do not make it, and what it reads, again."""
    return raw.select("*", F.inline(F.array(F.struct(record_error(max_turns=max_turns, risk_labels=risk_labels).alias("error")))))


def contract(raw: DataFrame, *, max_turns: int = 10, risk_labels: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad ones with their ``error``."""
    rows = checked(raw, max_turns=max_turns, risk_labels=risk_labels)
    return rows.where("error IS NULL").drop("error"), rows.where("error IS NOT NULL")


def forbidden_paths(items: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """``key, name, path`` of every field of a VARIANT, at any depth, whose name a public item must not have.

    A look at the text, which is narrow, keeps items without such a name out;
    the others are taken apart level by level, maps and arrays included, until nothing is left to open.
    """
    spark = items.sparkSession
    named = F.to_json(raw).rlike('"(' + "|".join(K.FORBIDDEN_PUBLIC_KEYS) + ')":')
    for limit in ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit"):  # else deep or many items would stop the job
        spark.conf.set(limit, "-1")
    names = ", ".join(f"'{name}'" for name in K.FORBIDDEN_PUBLIC_KEYS)
    return spark.sql(
        f"""WITH RECURSIVE walk(k, path, name, value) AS (
          SELECT `{key}`, '$', CAST(NULL AS STRING), `{raw}` FROM {{items}}
          UNION ALL SELECT w.k, concat(w.path, if(e.key IS NULL, concat('[', e.pos, ']'), concat('.', e.key))), e.key, e.value FROM walk w, LATERAL variant_explode(w.value) e)
        SELECT k AS `{key}`, name, path FROM walk WHERE name IN ({names})""",
        items=items.where(named).select(key, raw),
    )


def forbidden_names(items: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """``key, names``: of the items that have such fields, the fields' names, each once and in order."""
    return forbidden_paths(items, key, raw).groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("names"))
