"""Settings of every stage, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any


def _pick(cls, values: dict[str, Any]):
    names = {f.name for f in fields(cls)}
    return cls(**{k: v for k, v in values.items() if k in names})


@dataclass(frozen=True)
class CleanConfig:
    min_chars: int = 50
    max_chars: int = 200_000
    max_urls: int = 10
    repeated_char_threshold: int = 20
    enable_pii_filter: bool = True
    min_info_ratio: float = 0.2
    min_unique_ratio: float = 0.04

    @classmethod
    def of(cls, config: dict[str, Any] | None) -> CleanConfig:
        """From a full configuration with a ``cleaning`` section, or from that section itself."""
        config = config or {}
        return _pick(cls, config.get("cleaning", config))


@dataclass(frozen=True)
class DedupConfig:
    exact: bool = True
    approximate: bool = True
    approximate_threshold: float = 0.85
    ngram_size: int = 5
    method: str = "exact"  # or "minhash": candidates from MinHash bands


@dataclass(frozen=True)
class SamplingConfig:
    max_records: int = 1000
    source_ratios: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class RunConfig:
    cleaning: CleanConfig = field(default_factory=CleanConfig)
    dedup: DedupConfig = field(default_factory=DedupConfig)
    sampling: SamplingConfig = field(default_factory=SamplingConfig)
    min_score: float = 0.45
    project: str = "corpusloom"

    @classmethod
    def of(cls, config: dict[str, Any] | None) -> RunConfig:
        """From nested sections: project, cleaning, dedup, quality, sampling."""
        config = config or {}
        return cls(
            cleaning=_pick(CleanConfig, config.get("cleaning", {})),
            dedup=_pick(DedupConfig, config.get("dedup", {})),
            sampling=_pick(SamplingConfig, config.get("sampling", {})),
            min_score=float(config.get("quality", {}).get("min_score", 0.45)),
            project=config.get("project", {}).get("name", "corpusloom"),
        )
