"""Settings that change results, checked when they are made."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

SECOND = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Fixed values are the defaults of the reference semantics."""

    window_s: int = 60
    allowed_lateness_s: float = 30.0
    idle_timeout_s: float | None = None
    partitions: int = 6
    cell_degrees: float = 5.0
    retention_days: int | None = None
    shed_fraction: float = 0.25

    def __post_init__(self):
        if self.window_s <= 0 or self.partitions <= 0 or self.cell_degrees <= 0:
            raise ValueError("window, partitions and cell size must be positive")
        if self.allowed_lateness_s < 0:
            raise ValueError("allowed lateness must not be negative")
        if self.idle_timeout_s is not None and self.idle_timeout_s <= self.allowed_lateness_s:
            raise ValueError("the idle timeout must exceed the allowed lateness")
        if self.retention_days is not None and self.retention_days <= 0:
            raise ValueError("retention must be a positive number of days")
        if not 0 <= self.shed_fraction <= 1:
            raise ValueError("the shed fraction lies between 0 and 1")

    @property
    def window_us(self) -> int:
        return self.window_s * SECOND

    @property
    def lateness_us(self) -> int:
        return round(self.allowed_lateness_s * SECOND)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        """Settings named in capitals; what is unset or empty keeps its default."""
        kinds = {"window_s": int, "partitions": int, "retention_days": int}
        return cls(**{f.name: kinds.get(f.name, float)(env[f.name.upper()]) for f in fields(cls) if env.get(f.name.upper())})
