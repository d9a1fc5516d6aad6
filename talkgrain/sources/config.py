"""Run configuration and persona catalogs: small files, checked on the driver before anything runs."""

from __future__ import annotations

import json
import os
from collections import Counter
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Config:
    dataset_name: str
    scenario_types: tuple[str, ...]
    risk_labels: tuple[str, ...]
    victims_path: str = ""
    attackers_path: str = ""
    max_victims: int = 12
    max_attackers: int = 24
    max_turns: int = 10
    attacker_model: str = ""
    victim_model: str = ""
    locale: str = "ko-KR"
    extra: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.max_turns <= 0 or self.max_victims <= 0 or self.max_attackers <= 0:
            raise ValueError("limits must be positive")
        for name in ("scenario_types", "risk_labels"):
            values = getattr(self, name)
            if not values or any(not isinstance(v, str) or not v.strip() for v in values):
                raise ValueError(f"{name} must be a list of non-empty strings")
            if repeated := [v for v, n in Counter(values).items() if n > 1]:
                raise ValueError(f"{name} has {repeated} twice")


def load_config(path: str) -> Config:
    """From JSON; environment variables override the model names; paths are relative to the folder above ``configs``."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    base = Path(path).resolve().parent
    base = base.parent if base.name == "configs" else base
    known = {f for f in Config.__dataclass_fields__ if f != "extra"}
    values = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in known}
    for key in ("victims_path", "attackers_path"):
        if values.get(key):
            values[key] = str(Path(values[key]) if Path(values[key]).is_absolute() else base / values[key])
    for key in ("attacker_model", "victim_model"):
        values[key] = os.environ.get(key.upper(), values.get(key, ""))
    return Config(**values, extra={k: v for k, v in raw.items() if k not in known})


def check_personas(personas: list[dict[str, Any]], lists: tuple[str, ...], limit: int) -> None:
    """Ids are unique, the named lists hold non-empty strings, and the catalog is within its limit."""
    if not personas:
        raise ValueError("a catalog must have a persona")
    if len(personas) > limit:
        raise ValueError(f"the catalog has {len(personas)} personas, the limit is {limit}")
    for k, p in enumerate(personas):
        if not isinstance(p.get("id"), str) or not p["id"].strip():
            raise ValueError(f"persona {k} has no id")
        for name in lists:
            value = p.get(name)
            if not isinstance(value, list) or not value or any(not isinstance(v, str) or not v.strip() for v in value):
                raise ValueError(f"{p['id']}: {name} must be a list of non-empty strings")
    if repeated := [i for i, n in Counter(p["id"] for p in personas).items() if n > 1]:
        raise ValueError(f"repeated ids: {repeated}")
