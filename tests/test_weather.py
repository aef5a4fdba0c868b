import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.operators import gold, silver
from agrilake.operators.rolling import Rolling, RollingDays, rolling_days, rolling_rows

BRONZE = (
    "timestamp string, city string, state string, region string, latitude double, longitude double, "
    "temperature_2m string, relative_humidity_2m double, precipitation_mm double, rain_mm double, "
    "wind_speed_kmh double, shortwave_radiation double, evapotranspiration double, source string, "
    "ingestion_timestamp string, pipeline_execution_id string"
)


def _bronze(spark, *changes):
    base = {
        "timestamp": "2026-08-15T00:00", "city": "Sorriso", "state": "MT", "region": "CO", "latitude": -12.5,
        "longitude": -55.7, "temperature_2m": "25.5", "relative_humidity_2m": 50.0, "precipitation_mm": 0.5,
        "rain_mm": 0.5, "wind_speed_kmh": 3.0, "shortwave_radiation": 10.0, "evapotranspiration": 0.1,
        "source": "open_meteo", "ingestion_timestamp": "2026-08-16T00:00:00", "pipeline_execution_id": "a",
    }
    rows = [{**base, **c} for c in changes]
    names = [part.split()[0] for part in BRONZE.split(", ")]
    return spark.createDataFrame([[r[n] for n in names] for r in rows], BRONZE)


def test_typing(spark):
    rows = silver.typed_weather(_bronze(spark, {}, {"timestamp": "soon", "temperature_2m": "n/a"})).collect()
    good = next(r for r in rows if r["event_timestamp"])
    bad = next(r for r in rows if not r["event_timestamp"])
    assert good["event_timestamp"] == dt.datetime(2026, 8, 15)
    assert (good["event_date"], good["year"], good["month"]) == (dt.date(2026, 8, 15), 2026, 8)
    assert good["temperature_2m"] == 25.5
    assert bad["temperature_2m"] is None and bad["event_date"] is None


def test_silver_keeps_only_valid_rows(spark):
    kept = silver.weather_silver(
        _bronze(
            spark,
            {"city": "ok"},
            {"city": "nothing measured", "temperature_2m": None, "relative_humidity_2m": None, "precipitation_mm": None, "wind_speed_kmh": None},
            {"city": "nan measure", "precipitation_mm": math.nan},
            {"city": "  "},
            {"city": None},
            {"timestamp": None},
            {"timestamp": "never"},
            {"latitude": None},
            {"latitude": 91.0},
            {"longitude": -181.0},
            {"relative_humidity_2m": 100.1},
            {"precipitation_mm": -0.1},
            {"wind_speed_kmh": -0.1},
            {"temperature_2m": "61"},
        )
    )
    assert sorted(r["city"] for r in kept.select("city").collect()) == ["nan measure", "nothing measured", "ok"]


def test_silver_takes_the_latest_run_of_a_record(spark):
    rows = _bronze(
        spark,
        {"temperature_2m": "20", "pipeline_execution_id": "a"},
        {"temperature_2m": "21", "pipeline_execution_id": "b"},
        {"temperature_2m": "22", "ingestion_timestamp": "2026-08-15T00:00:00", "pipeline_execution_id": "c"},
    )
    assert [r["temperature_2m"] for r in silver.weather_silver(rows.repartition(3)).collect()] == [21.0]


def test_deduplication_cuts_rows_before_the_shuffle(spark):
    plan = silver.weather_silver(_bronze(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def _expected(rows, sizes):
    """Brute force over (group, day, tie, value) rows sorted like the window."""
    out = {}
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        history = groups.setdefault(row[0], [])
        history.append(row[3])
        for size in sizes:
            frame = [v for v in history[-size:] if v is not None]
            out[(row[0], row[1], row[2], size)] = (sum(frame) if frame else None, sum(frame) / len(frame) if frame else None)
    return out


@pytest.mark.parametrize("per_day", [1, 3, 80])
def test_rolling_rows_equal_a_plain_row_frame(spark, per_day):
    """Gaps between days, days with more rows than a frame, missing values, a group with most of the rows."""
    rng = random.Random(per_day)
    rows = []
    for group, days in (("hot", 40), ("cold", 5), ("lone", 1)):
        for d in range(days):
            if rng.random() < 0.3:
                continue
            for tie in range(rng.randint(1, per_day) if group != "hot" else per_day):
                rows.append((group, dt.date(2024, 1, 1) + dt.timedelta(days=d), tie, rng.choice([None, float(rng.randrange(64))])))
    df = spark.createDataFrame(rows, "g string, d date, tie int, v double").repartition(4)
    measures = [Rolling("s7", "sum", "v", 7), Rolling("a30", "avg", "v", 30)]
    got = rolling_rows(df, ["g"], "d", ["tie"], measures).collect()
    expected = _expected(rows, (7, 30))
    assert len(got) == len(rows)
    for r in got:
        key = (r["g"], r["d"], r["tie"])
        assert r["s7"] == expected[(*key, 7)][0]
        wanted = expected[(*key, 30)][1]
        assert r["a30"] == (wanted if wanted is None else pytest.approx(wanted))


def test_rolling_handles_missing_days_and_groups(spark):
    rows = [(None, None, i, 1.0) for i in range(10)] + [("g", None, i, 1.0) for i in range(10)] + [("g", dt.date(2024, 1, 1), 0, 1.0)]
    df = spark.createDataFrame(rows, "g string, d date, tie int, v double")
    got = rolling_rows(df, ["g"], "d", ["tie"], [Rolling("s", "sum", "v", 3)]).collect()
    assert sorted(r["s"] for r in got if r["g"] is None) == [1.0, 2.0] + [3.0] * 8
    assert next(r["s"] for r in got if r["d"] is not None) == 3.0


HOURS = (
    "event_date date, city string, state string, region string, latitude double, longitude double, source string, "
    "temperature_2m double, precipitation_mm double, relative_humidity_2m double, wind_speed_kmh double, "
    "shortwave_radiation double, evapotranspiration double"
)


def _hour(day, temperature=20.0, rain=0.0, city="A", source="s"):
    return (dt.date(2024, 1, day), city, "MT", "CO", -1.0, -2.0, source, temperature, rain, 50.0, 4.0, 10.0, 0.5)


def test_daily_aggregates(spark):
    rows = [_hour(1, 10.0, 1.0), _hour(1, 20.0, 2.0), _hour(2, None, None), _hour(2, None, None)]
    first, second = gold.daily_weather(spark.createDataFrame(rows, HOURS)).orderBy("event_date").collect()
    assert (first["avg_temperature"], first["max_temperature"], first["min_temperature"]) == (15.0, 20.0, 10.0)
    assert (first["total_precipitation"], first["solar_radiation"], first["evapotranspiration"]) == (3.0, 20.0, 1.0)
    assert second["total_precipitation"] is None and second["avg_temperature"] is None


def test_daily_groups_keep_missing_keys(spark):
    df = spark.createDataFrame([_hour(1), _hour(1)], HOURS).withColumn("region", F.lit(None).cast("string"))
    assert gold.daily_weather(df).count() == 1


def test_gold_windows_count_rows_not_days_and_flags(spark):
    days = [1, 2, 3, 10, 11, 20, 21, 30]  # seven rows reach back to the 2nd, far more than seven days
    rows = [_hour(d, 34.0 if d < 30 else 36.0, 0.0 if d != 1 else 60.0) for d in days]
    out = {r["event_date"].day: r for r in gold.weather_gold(spark.createDataFrame(rows, HOURS)).collect()}
    assert out[1]["days_without_rain"] == 0 and out[1]["heavy_rain_risk"] == "high"
    assert out[21]["days_without_rain"] == 6 and out[21]["precipitation_accumulated_7d"] == 60.0
    assert out[30]["days_without_rain"] == 7 and out[30]["precipitation_accumulated_7d"] == 0.0
    assert out[30]["precipitation_accumulated_30d"] == 60.0
    assert [out[d]["drought_risk"] for d in (21, 30)] == ["normal", "high"]
    assert [out[d]["heat_risk"] for d in (21, 30)] == ["normal", "high"]
    assert out[30]["thermal_amplitude"] == 0.0
    assert (out[30]["year"], out[30]["month"]) == (2024, 1)
    cooler = Thresholds.from_mapping({"drought": {"avg_temperature_7d_min_c": 35}})
    assert gold.weather_gold(spark.createDataFrame(rows, HOURS), cooler).where("drought_risk = 'high'").count() == 0


def test_two_sources_share_a_city_frame_in_a_fixed_order(spark):
    rows = [_hour(1, rain=1.0, source="b"), _hour(1, rain=2.0, source="a"), _hour(2, rain=4.0, source="a")]
    out = gold.weather_gold(spark.createDataFrame(rows, HOURS)).collect()
    sums = {(r["event_date"].day, r["source"]): r["precipitation_accumulated_7d"] for r in out}
    assert sums == {(1, "a"): 2.0, (1, "b"): 3.0, (2, "a"): 7.0}


def test_calendar_frames_equal_brute_force(spark):
    """Gaps, several rows a day, missing values, null cities and days."""
    start = dt.date(2026, 1, 1)
    days = [0, 1, 1, 1, 4, 9, 10, 36, 39, None, None]
    rows = [
        (None if d is None else start + dt.timedelta(days=d), city, None if i % 4 == 3 else float(i))
        for city in ("A", "B", None)
        for i, d in enumerate(days)
        if city != "B" or i % 2
    ]
    df = spark.createDataFrame(rows, "day date, city string, v double")
    measures = [RollingDays("total", "sum", "v", 7), RollingDays("mean", "avg", "v", 30)]
    found = rolling_days(df, ["city"], "day", measures).collect()

    def frame(city, day, reach):
        same = [(d, v) for d, c, v in rows if c == city and v is not None]
        if day is None:
            return [v for d, v in same if d is None]
        return [v for d, v in same if d is not None and 0 <= (day - d).days < reach]

    expected = []
    for day, city, v in rows:
        week, month = frame(city, day, 7), frame(city, day, 30)
        expected.append((day, city, v, sum(week) if week else None, sum(month) / len(month) if month else None))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    # frames of rows reach over the gaps
    by_rows = rolling_rows(df.where("city = 'A' AND day IS NOT NULL"), ["city"], "day", ["v"], [Rolling("total", "sum", "v", 7)])
    assert by_rows.where("total <> 0").count() and {r["total"] for r in by_rows.collect()} != {r["total"] for r in found if r["city"] == "A"}
