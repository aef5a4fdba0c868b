"""Risk flags, levels and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.schemas import RISK_COLUMNS

# Fixed values of the data contract.
HIGH, NORMAL = "high", "normal"
RISK_LEVELS = ["Normal", "Atencao", "Critico"]
RISK_TYPES = {"drought_risk": "Seca", "heat_risk": "Calor", "heavy_rain_risk": "Chuva forte"}
DRY_DAY_BELOW_MM = 1
HOT_FROM_C, WARM_FROM_C = 28, 24


def is_dry_day(rain: Column) -> Column:
    """1 for less than 1 mm of rain; a day without a rain reading counts as dry."""
    return F.when(F.coalesce(rain.cast("double"), F.lit(0.0)) < DRY_DAY_BELOW_MM, 1).otherwise(0)


def _flag(condition: Column) -> Column:
    return F.when(condition, HIGH).otherwise(NORMAL)


def drought_risk(limits: Thresholds) -> Column:
    rule = limits.drought
    return _flag(
        (F.col("precipitation_accumulated_7d") <= rule.precipitation_7d_max_mm)
        & (F.col("days_without_rain") >= rule.consecutive_dry_days_min)
        & (F.col("avg_temperature_7d") >= rule.avg_temperature_7d_min_c)
    )


def heat_risk(limits: Thresholds) -> Column:
    return _flag(F.col("max_temperature") >= limits.heat.max_temperature_c)


def heavy_rain_risk(limits: Thresholds) -> Column:
    return _flag(F.col("total_precipitation") >= limits.heavy_rain.daily_precipitation_mm)


def risk_events() -> Column:
    """How many of the three flags are high."""
    high = [F.when(F.col(name) == HIGH, 1).otherwise(0) for name in RISK_COLUMNS]
    return (high[0] + high[1] + high[2]).cast("long")


def risk_level(events: Column) -> Column:
    normal, watch, critical = RISK_LEVELS
    return F.when(events <= 0, normal).when(events <= 1, watch).when(events <= 3, critical)


def temperature_band(value: Column) -> Column:
    return F.when(value >= HOT_FROM_C, "hot").when(value >= WARM_FROM_C, "warm").otherwise("mild")
