"""Settings from YAML, checked and with defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

import yaml


@dataclass(frozen=True)
class Missing:
    warning_threshold: float = 0.0
    critical_threshold: float = 0.5
    exclusion_candidate_threshold: float = 0.3
    report_top_n_columns: int = 5


@dataclass(frozen=True)
class NumericSummary:
    enabled: bool = True


@dataclass(frozen=True)
class Categorical:
    report_top_n_values: int = 5


@dataclass(frozen=True)
class Quality:
    missing: Missing = field(default_factory=Missing)
    numeric_summary: NumericSummary = field(default_factory=NumericSummary)
    categorical: Categorical = field(default_factory=Categorical)


@dataclass(frozen=True)
class MissingValues:
    """Accepted for compatibility; `placeholders` only acts where a reader is told to use it."""

    max_missing_ratio: float = 0.3
    placeholders: tuple[str, ...] = ("?", "NA", "N/A", "")
    strategy: str = "ignore"


@dataclass(frozen=True)
class Outliers:
    method: str = "iqr"
    iqr_multiplier: float = 1.5
    numeric_only: bool = True


@dataclass(frozen=True)
class Logging:
    level: str = "INFO"
    log_dir: str = "logs"


@dataclass(frozen=True)
class Settings:
    quality: Quality = field(default_factory=Quality)
    missing_values: MissingValues = field(default_factory=MissingValues)
    outliers: Outliers = field(default_factory=Outliers)
    logging: Logging = field(default_factory=Logging)


def _fill(kind: type, given: Any, where: str) -> Any:
    if given is None:
        return kind()
    if not isinstance(given, dict):
        raise ValueError(f"{where or 'the configuration'} must be a mapping")
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"unknown configuration keys: {', '.join(f'{where}{u}' for u in unknown)}")
    values = {}
    for name, value in given.items():
        default = getattr(kind(), name)
        if is_dataclass(default):
            value = _fill(type(default), value, f"{where}{name}.")
        elif isinstance(default, tuple):
            value = tuple(value)
        elif isinstance(default, bool):
            if not isinstance(value, bool):
                raise ValueError(f"{where}{name} must be true or false")
        elif isinstance(default, float):
            value = float(value)
        elif isinstance(default, int):
            value = int(value)
        values[name] = value
    return kind(**values)


def settings_from(mapping: dict | None) -> Settings:
    return _fill(Settings, mapping, "")


def load_settings(path: str | Path) -> Settings:
    """Reads YAML without running tags; keys that are absent take their defaults."""
    with open(path, encoding="utf-8") as f:
        return settings_from(yaml.safe_load(f))
