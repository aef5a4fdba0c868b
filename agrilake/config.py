"""Parameters of the operators and jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# The two sources the lake knows, as they appear in the data.
WEATHER_SOURCE = "open_meteo"
AGRICULTURE_SOURCE = "ibge_pam"


@dataclass(frozen=True)
class DroughtRule:
    precipitation_7d_max_mm: float = 5
    consecutive_dry_days_min: int = 7
    avg_temperature_7d_min_c: float = 30


@dataclass(frozen=True)
class HeatRule:
    max_temperature_c: float = 35


@dataclass(frozen=True)
class HeavyRainRule:
    daily_precipitation_mm: float = 50


@dataclass(frozen=True)
class QualityLimits:
    min_temperature_c: float = -20
    max_temperature_c: float = 60
    min_humidity_pct: float = 0
    max_humidity_pct: float = 100
    min_precipitation_mm: float = 0
    min_wind_speed_kmh: float = 0


@dataclass(frozen=True)
class Thresholds:
    """Risk and quality limits; a section or key that is not given keeps its default."""

    drought: DroughtRule = field(default_factory=DroughtRule)
    heat: HeatRule = field(default_factory=HeatRule)
    heavy_rain: HeavyRainRule = field(default_factory=HeavyRainRule)
    quality: QualityLimits = field(default_factory=QualityLimits)

    @classmethod
    def from_mapping(cls, sections: Mapping[str, Mapping[str, float]] | None) -> Thresholds:
        given = sections or {}
        return cls(**{f.name: f.default_factory(**(given.get(f.name) or {})) for f in fields(cls)})


@dataclass(frozen=True)
class LakeConfig:
    """Where a lake lives and how its jobs behave. ``root`` is any path Spark can read and write."""

    root: str
    initial_ingestion_date: dt.date = dt.date(2026, 8, 1)
    strict: bool = False
    thresholds: Thresholds = field(default_factory=Thresholds)

    def layer(self, name: str, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{name}/{dataset}"

    @property
    def metadata_root(self) -> str:
        return f"{self.root.rstrip('/')}/metadata"

    @property
    def warehouse_root(self) -> str:
        return f"{self.root.rstrip('/')}/warehouse"

    def staging_root(self, spark: Any) -> str:
        """Shared folder for tables that only cut a plan in two: the cluster's, else the lake's own."""
        shared = spark.conf.get("spark.checkpoint.dir", "") or f"{self.root.rstrip('/')}/_staging"
        return shared.rstrip("/")
