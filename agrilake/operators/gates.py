"""Blocking dataset gates: every check of a layer in one aggregate, a report and an exception."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.errors import DataValidationError
from agrilake.functions.numbers import nan_to_null
from agrilake.schemas import BRONZE_REQUIRED, GOLD_AGRICULTURE_REQUIRED, GOLD_REQUIRED, SILVER_REQUIRED


@dataclass(frozen=True)
class Gate:
    """What a layer has to fulfil. ``ranges`` maps a column to the condition each of its rows must meet."""

    label: str
    required: Sequence[str]
    non_null: Sequence[str]
    ranges: dict[str, Column] = field(default_factory=dict)
    unique: str | None = None


def _optional(name: str, low: float, high: float | None = None) -> Column:
    value = F.col(name)
    return F.coalesce(value >= low if high is None else value.between(low, high), F.lit(True))


def _coordinates() -> dict[str, Column]:
    return {
        "latitude": F.coalesce(F.col("latitude").between(-90, 90), F.lit(False)),
        "longitude": F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)),
    }


def _hourly_ranges(limits: Thresholds) -> dict[str, Column]:
    q = limits.quality
    return {
        **_coordinates(),
        "relative_humidity_2m": _optional("relative_humidity_2m", q.min_humidity_pct, q.max_humidity_pct),
        "precipitation_mm": _optional("precipitation_mm", q.min_precipitation_mm),
        "wind_speed_kmh": _optional("wind_speed_kmh", q.min_wind_speed_kmh),
        "temperature_2m": _optional("temperature_2m", q.min_temperature_c, q.max_temperature_c),
    }


def bronze_weather_gate(limits: Thresholds | None = None) -> Gate:
    non_null = ["timestamp", "city", "state", "latitude", "longitude"]
    return Gate("bronze weather", BRONZE_REQUIRED, non_null, _hourly_ranges(limits or Thresholds()))


def silver_weather_gate(limits: Thresholds | None = None) -> Gate:
    non_null = ["weather_record_id", "event_timestamp", "event_date", "city", "state", "latitude", "longitude"]
    ranges = _hourly_ranges(limits or Thresholds())
    return Gate("silver weather", SILVER_REQUIRED, non_null, ranges, unique="weather_record_id")


def gold_weather_gate(limits: Thresholds | None = None) -> Gate:
    q = (limits or Thresholds()).quality
    degrees = (q.min_temperature_c, q.max_temperature_c)
    ranges = {
        **_coordinates(),
        "avg_humidity": _optional("avg_humidity", q.min_humidity_pct, q.max_humidity_pct),
        "total_precipitation": _optional("total_precipitation", q.min_precipitation_mm),
        "days_without_rain": _optional("days_without_rain", 0),
        "avg_temperature": _optional("avg_temperature", *degrees),
        "max_temperature": _optional("max_temperature", *degrees),
        "min_temperature": _optional("min_temperature", *degrees),
    }
    return Gate("gold weather", GOLD_REQUIRED, ["event_date", "city", "state", "latitude", "longitude"], ranges)


def gold_agriculture_gate() -> Gate:
    amounts = ["produced_quantity", "production_value", "harvested_area", "reported_yield_kg_ha"]
    non_null = ["year", "territory_code", "territory_name", "product_code", "product_name"]
    ranges = {name: _optional(name, 0) for name in amounts}
    return Gate("gold agriculture", GOLD_AGRICULTURE_REQUIRED, non_null, ranges)


def _failure_counts(df: DataFrame, gate: Gate) -> DataFrame:
    nulls = [F.count_if(F.col(name).isNull()).alias(f"null:{name}") for name in gate.non_null]
    ranges = [F.count_if(~ok).alias(f"range:{name}") for name, ok in gate.ranges.items()]
    return nan_to_null(df).agg(F.count(F.lit(1)).alias("rows"), *nulls, *ranges)


def gate_report(df: DataFrame, gate: Gate) -> DataFrame:
    """(check_name, failed_rows): one row per check, all from one pass over the data."""
    counts = _failure_counts(df, gate)
    checks = [c for c in counts.columns if c != "rows"]
    return counts.unpivot([], checks, "check_name", "failed_rows")


def repeated_values(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_columns(df: DataFrame, gate: Gate) -> None:
    missing = sorted(set(gate.required) - set(df.columns))
    if missing:
        raise DataValidationError(f"{gate.label}: no such columns: {', '.join(missing)}")


def check(df: DataFrame, gate: Gate) -> dict[str, int | str]:
    """Run a gate. Returns status and row count, or raises with the first kind of failure found."""
    if not df.columns:
        raise DataValidationError(f"{gate.label}: not a single row")
    require_columns(df, gate)
    counts = _failure_counts(df, gate).first().asDict()
    if counts["rows"] == 0:
        raise DataValidationError(f"{gate.label}: not a single row")
    nulls = [name for name in gate.non_null if counts[f"null:{name}"]]
    if nulls:
        raise DataValidationError(f"{gate.label}: a value is due but null in {', '.join(nulls)}")
    out_of_range = [name for name in gate.ranges if counts[f"range:{name}"]]
    if out_of_range:
        raise DataValidationError(f"{gate.label}: beyond the limits: {', '.join(out_of_range)}")
    if gate.unique and not repeated_values(df, [gate.unique]).isEmpty():
        raise DataValidationError(f"{gate.label}: rows share an id, duplicate {gate.unique}")
    return {"status": "ok", "records_checked": counts["rows"]}


def check_path(spark: SparkSession, path: str, gate: Gate) -> dict[str, int | str]:
    """Gate over a Parquet dataset; a path that is not there is a failure of the gate."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise DataValidationError(f"{gate.label}: nothing is stored at {path}") from missing
        if missing.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise DataValidationError(f"{gate.label}: not a single file at {path}") from missing
        raise
    return check(df, gate)
