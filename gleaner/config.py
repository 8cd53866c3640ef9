"""Settings read from TOML."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Settings:
    """Sections as dictionaries, with the defaults that the engine falls back on."""

    crawl: dict[str, Any] = field(default_factory=dict)
    pipeline: dict[str, Any] = field(default_factory=dict)
    embedding: dict[str, Any] = field(default_factory=dict)
    llm: dict[str, Any] = field(default_factory=dict)
    output: dict[str, Any] = field(default_factory=dict)
    prompts: dict[str, Any] = field(default_factory=dict)

    @property
    def languages(self) -> list[str]:
        return list(self.crawl.get("languages", []))

    @property
    def capacity(self) -> int:
        return int(self.pipeline.get("capacity", 1000))

    @property
    def dedupe_capacity(self) -> int:
        """Fingerprints that the bounded window of the deduplication holds."""
        return int(self.pipeline.get("dedupe_capacity", 100_000))

    @property
    def min_keywords(self) -> int:
        return int(self.pipeline.get("min_keywords", 1))

    @property
    def threshold(self) -> float | None:
        """Least similarity of the optional relevance filter; None leaves it off."""
        value = self.pipeline.get("relevance_threshold")
        return None if value is None else float(value)

    @property
    def parallel(self) -> int:
        return max(1, int(self.llm.get("parallel", 4)))


def load_settings(path: str = "settings.toml") -> Settings:
    with open(path, "rb") as f:
        raw = tomllib.load(f)
    known = {k: raw[k] for k in Settings.__dataclass_fields__ if k in raw}
    return Settings(**known)
