import datetime as dt
import math

from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.functions import calendar, ids, labels, numbers, risk


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_statistic_parser(spark):
    texts = {
        None: None,
        "-": None,
        "...": None,
        "": None,
        "abc": None,
        "X": None,
        "1.234,5": None,
        "1d": None,
        "nan": None,
        "12,5": 12.5,
        " 7 ": 7.0,
        "456.7": 456.7,
        "-1e3": -1000.0,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = {r["t"]: r["v"] for r in rows.select("t", numbers.parse_statistic(F.col("t")).alias("v")).collect()}
    assert parsed == texts


def test_nan_is_missing_and_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(math.nan, 1.0), (2.0, 0.0)], "a double, b double")
    rows = numbers.nan_to_null(df).select("a", numbers.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (2.0, None)]


def test_record_id_is_a_stable_sha256(spark):
    df = spark.createDataFrame([("Sorriso", "2026-08-15T00:00", -12.5, -55.7)] * 2, "city string, timestamp string, latitude double, longitude double")
    found = {r[0] for r in df.select(ids.weather_record_id()).collect()}
    assert len(found) == 1 and len(found.pop()) == 64


def test_row_numbers_are_dense_and_independent_of_partitioning(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    one = {r["key"]: r["n"] for r in ids.number_rows(rows.coalesce(1), ["key"], "n", 10).collect()}
    many = {r["key"]: r["n"] for r in ids.number_rows(rows.repartition(7), ["key"], "n", 10).collect()}
    assert one == many
    assert sorted(one.values()) == list(range(10, 5010))


def test_calendar(spark):
    days = [dt.date(2024, 1, 1), dt.date(2023, 1, 1), dt.date(2026, 8, 15), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    columns = [c.alias(n) for n, c in calendar.calendar_columns(F.col("d")).items()]
    for row in df.select(*columns).collect():
        d = row["full_date"]
        assert row["date_id"] == int(d.strftime("%Y%m%d"))
        assert (row["day_of_week"], row["week"]) == (d.isoweekday(), d.isocalendar().week)
        assert (row["month_name"], row["quarter"]) == (d.strftime("%B"), (d.month + 2) // 3)
        assert row["is_weekend"] == (d.isoweekday() >= 6)


def test_risk_levels_and_bands(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "n int")
    levels = [r[0] for r in df.orderBy("n").select(risk.risk_level(F.col("n"))).collect()]
    assert levels == ["Normal", "Atencao", "Critico", "Critico"]
    bands = [_one(spark, risk.temperature_band(F.lit(t))) for t in (28.0, 27.9, 24.0, 23.9)]
    assert bands == ["hot", "warm", "warm", "mild"]


def test_dry_day_counts_a_missing_reading_as_dry(spark):
    df = spark.createDataFrame([(None,), (0.99,), (1.0,)], "r double")
    assert [r[0] for r in df.select(risk.is_dry_day(F.col("r"))).collect()] == [1, 1, 0]


def test_thresholds_keep_defaults_for_what_is_not_given():
    limits = Thresholds.from_mapping({"drought": {"precipitation_7d_max_mm": 8}, "heat": {"max_temperature_c": 38}})
    assert limits.drought.precipitation_7d_max_mm == 8
    assert limits.drought.consecutive_dry_days_min == 7
    assert limits.heat.max_temperature_c == 38
    assert limits.heavy_rain.daily_precipitation_mm == 50
    assert limits.quality.max_humidity_pct == 100
    assert Thresholds.from_mapping(None) == Thresholds()


def test_labels(spark):
    def delta(now, before, suffix=""):
        return _one(spark, labels.signed_delta(F.lit(now).cast("double"), F.lit(before).cast("double"), suffix))

    assert delta(21.5, 20.0, " C") == "+1.5 C"
    assert delta(20.0, 21.5, "%") == "-1.5%"
    assert delta(3.0, 3.0) == "+0.0"
    assert delta(2.96, 3.0) == "-0.0"
    assert delta(0.25, 0.0) == "+0.2"  # ties go to the even digit
    assert delta(1.0, None) is None
    assert _one(spark, labels.percent_of(F.lit(1), F.lit(8))) == 12.5
    assert _one(spark, labels.percent_of(F.lit(1), F.lit(0))) is None
    assert _one(spark, labels.events_label(F.lit(3), F.lit(37.5))) == "3 eventos (37.5%)"
    assert _one(spark, labels.millions(F.lit(12_345_678), "M t")) == "12.3M t"
    assert _one(spark, labels.city_label(F.lit("Sorriso"), F.lit("MT"))) == "Sorriso/MT"


def test_state_codes(spark):
    assert len(labels.STATE_BY_CODE) == 27
    assert _one(spark, labels.state_of(F.lit("51"))) == "MT"
    assert _one(spark, labels.state_of(F.lit("99"))) is None
