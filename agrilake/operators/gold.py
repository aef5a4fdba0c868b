"""Silver to gold: daily aggregates per city, rolling windows, risk flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.functions import risk
from agrilake.operators.rolling import Rolling, RollingDays, rolling_days, rolling_rows
from agrilake.schemas import DAILY_KEYS, DAILY_MEASURES

WEEK, MONTH = 7, 30
ROLLING = [
    Rolling("days_without_rain", "sum", "is_dry_day", WEEK),
    Rolling("precipitation_accumulated_7d", "sum", "total_precipitation", WEEK),
    Rolling("precipitation_accumulated_30d", "sum", "total_precipitation", MONTH),
    Rolling("avg_temperature_7d", "avg", "avg_temperature", WEEK),
    Rolling("avg_temperature_30d", "avg", "avg_temperature", MONTH),
]
CALENDAR = [
    RollingDays("dry_days_in_7_days", "sum", "is_dry_day", WEEK),
    RollingDays("precipitation_in_7_days", "sum", "total_precipitation", WEEK),
    RollingDays("precipitation_in_30_days", "sum", "total_precipitation", MONTH),
    RollingDays("avg_temperature_in_7_days", "avg", "avg_temperature", WEEK),
    RollingDays("avg_temperature_in_30_days", "avg", "avg_temperature", MONTH),
]
_AGGREGATES = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def daily_weather(silver: DataFrame) -> DataFrame:
    """One row per day, city, coordinates and source; missing keys form groups, all-missing measures stay null."""
    measures = [_AGGREGATES[kind](column).alias(name) for name, (kind, column) in DAILY_MEASURES.items()]
    return silver.groupBy(*DAILY_KEYS).agg(*measures)


def with_rolling(daily: DataFrame) -> DataFrame:
    """Dry-day counts, rain sums and temperature means over the last 7 and 30 rows (not days) of a city.

    The frame belongs to (city, state); coordinates and source only break ties between rows of one day.
    """
    flagged = daily.withColumn("is_dry_day", risk.is_dry_day(F.col("total_precipitation")))
    ties = ["latitude", "longitude", "source", "region"]
    return rolling_rows(flagged, ["city", "state"], "event_date", ties, ROLLING)


def with_calendar_rolling(daily: DataFrame) -> DataFrame:
    """The same measures over the last 7 and 30 calendar days: a city's missing days make a frame hold fewer rows."""
    flagged = daily.withColumn("is_dry_day", risk.is_dry_day(F.col("total_precipitation")))
    return rolling_days(flagged, ["city", "state"], "event_date", CALENDAR)


def with_risk_flags(rolled: DataFrame, limits: Thresholds | None = None) -> DataFrame:
    limits = limits or Thresholds()
    return rolled.withColumns(
        {
            "thermal_amplitude": F.col("max_temperature") - F.col("min_temperature"),
            "drought_risk": risk.drought_risk(limits),
            "heat_risk": risk.heat_risk(limits),
            "heavy_rain_risk": risk.heavy_rain_risk(limits),
        }
    )


def weather_gold(silver: DataFrame, limits: Thresholds | None = None) -> DataFrame:
    gold = with_risk_flags(with_rolling(daily_weather(silver)), limits)
    return gold.withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
