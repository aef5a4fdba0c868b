import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from agrilake.errors import DataValidationError
from agrilake.operators import gates
from agrilake.schemas import GOLD_AGRICULTURE, GOLD_WEATHER, SILVER_WEATHER
from agrilake.operators.upsert import conform


def _silver(spark, **changes):
    values = {
        "timestamp": "2026-08-15T00:00", "city": "Sorriso", "state": "MT", "latitude": -12.5, "longitude": -55.7,
        "temperature_2m": 25.0, "relative_humidity_2m": 70.0, "precipitation_mm": 0.0, "wind_speed_kmh": 5.0,
        "weather_record_id": "id-1", "event_timestamp": dt.datetime(2026, 8, 15), "event_date": dt.date(2026, 8, 15),
        "year": 2026, "month": 8, **changes,
    }
    return conform(spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]), SILVER_WEATHER)


def test_silver_gate_accepts(spark):
    assert gates.check(_silver(spark), gates.silver_weather_gate()) == {"status": "ok", "records_checked": 1}


def test_silver_gate_rejects_duplicates_last(spark):
    twice = _silver(spark).union(_silver(spark))
    with pytest.raises(DataValidationError, match="duplicate weather_record_id"):
        gates.check(twice, gates.silver_weather_gate())
    with pytest.raises(DataValidationError, match="beyond the limits: temperature_2m"):
        gates.check(twice.union(_silver(spark, temperature_2m=80.0)), gates.silver_weather_gate())


def test_order_of_failures(spark):
    gate = gates.silver_weather_gate()
    with pytest.raises(DataValidationError, match="no such columns: month, year"):
        gates.check(_silver(spark, city=None).drop("year", "month"), gate)
    with pytest.raises(DataValidationError, match="null in city, latitude$"):
        gates.check(_silver(spark, city=None, latitude=None), gate)
    with pytest.raises(DataValidationError, match="not a single row"):
        gates.check(_silver(spark).limit(0), gate)


def test_missing_and_nan_measures_pass(spark):
    df = _silver(spark, temperature_2m=None, precipitation_mm=math.nan)
    assert gates.check(df, gates.silver_weather_gate())["status"] == "ok"


def _gold(spark, **changes):
    values = {
        "event_date": dt.date(2026, 8, 15), "city": "Sorriso", "state": "MT", "region": "CO", "latitude": -12.5,
        "longitude": -55.7, "source": "open_meteo", "avg_temperature": 25.0, "max_temperature": 30.0,
        "min_temperature": 20.0, "total_precipitation": 0.0, "avg_humidity": 50.0, "days_without_rain": 1, **changes,
    }
    return conform(spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]), GOLD_WEATHER)


def test_gold_gate(spark):
    gate = gates.gold_weather_gate()
    assert gates.check(_gold(spark), gate)["records_checked"] == 1
    with pytest.raises(DataValidationError, match="thermal_amplitude"):
        gates.check(_gold(spark).drop("thermal_amplitude"), gate)
    with pytest.raises(DataValidationError, match="avg_humidity, days_without_rain"):
        gates.check(_gold(spark, avg_humidity=101.0, days_without_rain=-1), gate)


def test_agriculture_gate(spark):
    values = {"year": 2024, "territory_code": "51", "territory_name": "n", "product_code": "p", "product_name": "p", "harvested_area": -1.0}
    df = conform(spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]), GOLD_AGRICULTURE)
    with pytest.raises(DataValidationError, match="harvested_area"):
        gates.check(df, gates.gold_agriculture_gate())
    assert gates.check(df.withColumn("harvested_area", F.lit(1.0)), gates.gold_agriculture_gate())["status"] == "ok"


def test_report_has_one_row_per_check(spark):
    report = {r["check_name"]: r["failed_rows"] for r in gates.gate_report(_silver(spark, city=None), gates.silver_weather_gate()).collect()}
    assert len(report) == 13 and report["null:city"] == 1 and sum(report.values()) == 1


def test_paths(spark, tmp_path):
    with pytest.raises(DataValidationError, match="nothing is stored at"):
        gates.check_path(spark, str(tmp_path / "none"), gates.silver_weather_gate())
    _silver(spark).write.parquet(str(tmp_path / "silver"))
    assert gates.check_path(spark, str(tmp_path / "silver"), gates.silver_weather_gate())["status"] == "ok"
    (tmp_path / "void").mkdir()
    with pytest.raises(DataValidationError, match="not a single file"):
        gates.check_path(spark, str(tmp_path / "void"), gates.silver_weather_gate())
