"""Rule tables as data: YAML in, one read-only object out."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import lru_cache
from pathlib import Path
from typing import Any

import yaml

HERE = Path(__file__).parent


@dataclass(frozen=True)
class Rules:
    """The rule tables one run works with. Any of them may be swapped."""

    taxonomy: dict[str, Any] = field(default_factory=dict)
    geography: dict[str, Any] = field(default_factory=dict)
    portal: dict[str, Any] = field(default_factory=dict)
    decision: dict[str, Any] = field(default_factory=dict)
    requirements: dict[str, Any] = field(default_factory=dict)
    profile: dict[str, Any] = field(default_factory=dict)

    @property
    def groups(self) -> list[dict[str, Any]]:
        return self.taxonomy["groups"]

    @property
    def deadline(self) -> dict[str, Any]:
        return self.decision["deadline"]

    @property
    def profile_configured(self) -> bool:
        p = self.profile
        return bool(p.get("strong") or p.get("moderate") or p.get("legal_name"))

    def with_profile(self, **values: Any) -> Rules:
        """A copy whose supplier profile holds just the given values."""
        return replace(self, profile=values)


@lru_cache(maxsize=None)
def load_rules(directory: str | None = None) -> Rules:
    """Read the YAML tables; a directory may override some of the files."""
    tables = {}
    for name in Rules.__dataclass_fields__:
        own = Path(directory) / f"{name}.yaml" if directory else None
        path = own if own is not None and own.exists() else HERE / f"{name}.yaml"
        tables[name] = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    return Rules(**tables)
