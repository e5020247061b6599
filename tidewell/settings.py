"""Settings: a base TOML file and an environment's own, merged by key."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    environment: str = "dev"
    root: str = "warehouse"
    timezone: str = "UTC"
    late_tolerance_minutes: int = 60
    future_tolerance_minutes: int = 5
    risk_threshold: float = 0.5
    max_investigations_per_run: int = 50
    storage: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.timezone != "UTC":
            raise ValueError("the timezone must be UTC")
        if self.late_tolerance_minutes < 0 or self.future_tolerance_minutes < 0:
            raise ValueError("tolerances must not be negative")
        if not 0 <= self.risk_threshold <= 1:
            raise ValueError("risk_threshold must lie between 0 and 1")
        if self.max_investigations_per_run < 0:
            raise ValueError("max_investigations_per_run must not be negative")


def merged(base: dict, over: dict) -> dict:
    """``over`` wins; tables merge key by key."""
    return base | {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def load(folder: str | Path, environment: str) -> Settings:
    files = [Path(folder) / f"{name}.toml" for name in ("base", environment)]
    if missing := [str(f) for f in files if not f.is_file()]:
        raise FileNotFoundError(", ".join(missing))
    values: dict = {}
    for file in files:
        values = merged(values, tomllib.loads(file.read_text()))
    return Settings(**({"environment": environment} | values))
