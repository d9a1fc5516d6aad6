"""Checks of configuration tables against each other: every offending entry is named, all at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.functions.text import stripped


@dataclass(frozen=True)
class Rule:
    """``kind``: ``refers`` (a value is there in another table's column), ``unique`` or ``filled``; ``key`` names a table's entries."""

    kind: str
    table: str
    column: str
    key: str = "id"
    to: str = ""
    to_column: str = "id"


def violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """``path, error, value`` of each entry that breaks a rule; a null refers to nothing, and is neither filled nor repeated."""

    def broken(rule: Rule) -> DataFrame:
        value = F.col(rule.column).cast("string")
        rows = tables[rule.table].select(F.concat(F.lit(f"{rule.table}["), F.coalesce(F.col(rule.key).cast("string"), F.lit("?")), F.lit(f"].{rule.column}")).alias("path"), value.alias("value"))
        if rule.kind == "refers":
            there = tables[rule.to].select(F.col(rule.to_column).cast("string").alias("value")).distinct()
            return rows.where("value IS NOT NULL").join(there, "value", "left_anti").select("path", F.lit(f"is not in {rule.to}").alias("error"), "value")
        if rule.kind == "unique":
            repeated = rows.where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("_n")).where("_n > 1").select("value")
            return rows.join(repeated, "value").select("path", F.lit("is repeated").alias("error"), "value")
        return rows.where(F.coalesce(stripped(F.col("value")) == "", F.lit(True))).select("path", F.lit("is empty").alias("error"), "value")

    return reduce(DataFrame.unionByName, map(broken, rules))


def check(tables: dict[str, DataFrame], rules: list[Rule], shown: int = 20) -> None:
    """Raise with the first few violations, by path, if there are any."""
    found = violations(tables, rules).orderBy("path", "error").limit(shown + 1).collect()
    if found:
        told = [f"{r.path} {r.error}: {r.value}" for r in found[:shown]] + ["..."] * (len(found) > shown)
        raise ValueError("; ".join(told))
