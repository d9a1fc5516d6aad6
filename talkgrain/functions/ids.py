"""Identity columns: hashes that equal those of the published files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "␟"


def _text(value: Column | str) -> Column:
    """Null reads ``None`` in a key, as in the published ids."""
    column = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(column.cast("string"), F.lit("None"))


def stable_id(prefix: str, *parts: Column | str, length: int = 12) -> Column:
    """``prefix_`` and the first hex digits of a SHA-256 of the joined parts."""
    digest = F.sha2(F.concat_ws(UNIT, *map(_text, parts)), 256)
    return F.concat(F.lit(f"{prefix}_"), F.substring(digest, 1, length))


def record_id(dataset: Column, victim: Column, attacker: Column, scenario: Column, index: Column) -> Column:
    """The dataset's name and 12 hex digits of a SHA-1 that does not depend on the dialogue."""
    key = F.concat_ws(":", *map(_text, (dataset, victim, attacker, scenario, index)))
    return F.concat(_text(dataset), F.lit("-"), F.substring(F.sha1(key), 1, 12))


def hash_bucket(key: Column, n: int | Column) -> Column:
    """The first 32 bits of a SHA-1, modulo ``n``."""
    return F.pmod(F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("bigint"), F.lit(n) if isinstance(n, int) else n)


def choose_stable(options: tuple[str, ...], *parts: Column | str, joiner: str = ":") -> Column:
    """One of ``options``, by the hash of the joined parts; empty without options."""
    if not options:
        return F.lit("")
    place = hash_bucket(F.concat_ws(joiner, *map(_text, parts)), len(options))
    return F.element_at(F.array(*map(F.lit, options)), (place + 1).cast("int"))
