import math
import random

import pytest
from pyspark.sql import functions as F

from agrilake.operators.quality import judge, rule_reason, split_judged

SCHEMA = (
    "seq long, timestamp string, city string, latitude double, longitude double, relative_humidity_2m double, "
    "precipitation_mm double, wind_speed_kmh double, temperature_2m double"
)
GOOD = ("2026-08-15T00:00", "Sorriso", -12.5, -55.7, 70.0, 0.0, 5.0, 25.0)


def _frame(spark, *records):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(records)], SCHEMA)


def _reasons(spark, *records):
    rows = _frame(spark, *records).select("seq", rule_reason().alias("r")).orderBy("seq").collect()
    return [r["r"] for r in rows]


def _with(**changes):
    names = ["timestamp", "city", "latitude", "longitude", "humidity", "rain", "wind", "temperature"]
    values = dict(zip(names, GOOD, strict=True))
    return tuple({**values, **changes}[n] for n in names)


def test_rules(spark):
    nothing_measured = _with(humidity=None, rain=None, wind=None, temperature=None)
    assert _reasons(spark, GOOD, nothing_measured) == ["", ""]
    assert _reasons(spark, _with(timestamp=None), _with(timestamp=""), _with(city=""), _with(city=None)) == [
        "timestamp_is_required", "timestamp_is_required", "city_is_required", "city_is_required",
    ]
    assert _reasons(spark, _with(latitude=None), _with(longitude=181.0)) == [
        "latitude_out_of_range", "longitude_out_of_range",
    ]
    assert _reasons(spark, _with(city="", humidity=101.0, rain=-1.0, wind=-1.0, temperature=61.0)) == [
        "city_is_required,relative_humidity_2m_out_of_range,precipitation_mm_below_minimum,"
        "wind_speed_kmh_below_minimum,temperature_2m_out_of_range"
    ]


def test_nan_fails_ranges_and_passes_minimums(spark):
    assert _reasons(spark, _with(temperature=math.nan), _with(rain=math.nan)) == ["temperature_2m_out_of_range", ""]


def _sequential(records):
    """Row by row, as the contract words it."""
    seen, out = set(), []
    for record, own in records:
        key = (record[1], record[0], record[2], record[3])
        if key in seen:
            out.append("duplicate_record")
        else:
            out.append(own)
            if not own:
                seen.add(key)
    return out


@pytest.mark.parametrize("hot_key_rows", [0, 3, 2_000_000])
def test_split_equals_the_sequential_algorithm(spark, hot_key_rows):
    rng = random.Random(7)
    records = []
    for _ in range(600):
        key = rng.choice([0, 0, 0, rng.randrange(40)])  # key 0 holds most rows
        city = rng.choice([None, "", *["C"] * 20])
        records.append(
            _with(
                timestamp=f"2026-08-15T{key:02d}:00", city=city and f"C{key}", latitude=rng.choice([1.0, 1.0, 99.0, None]),
                temperature=rng.choice([20.0, 70.0, None]),
            )
        )
    df = _frame(spark, *records)
    own = [r["r"] for r in df.select("seq", rule_reason().alias("r")).orderBy("seq").collect()]
    judged = judge(df.repartition(5), "seq", hot_key_rows=hot_key_rows)
    got = {r["seq"]: (r["reason"], r["accepted"]) for r in judged.collect()}
    expected = _sequential(list(zip(records, own, strict=True)))
    assert len(got) == len(records)
    assert [got[i] for i in range(len(records))] == [(reason, reason == "") for reason in expected]


def test_all_null_keys_spread_over_partitions(spark):
    """The usual hot key must not meet in one shuffle partition."""
    df = _frame(spark, *[_with(timestamp=None, city=None, latitude=None)] * 400)
    judged = judge(df, "seq")
    assert judged.where("reason like '%duplicate%'").count() == 0
    assert judged.count() == 400


def test_quarantine_rows(spark):
    df = _frame(spark, GOOD, GOOD, _with(humidity=120.0, timestamp="2026-08-15T01:00"))
    split = split_judged(judge(df, "seq"), df.columns, "run-1")
    assert split.accepted.columns == df.columns and split.accepted.count() == 1
    rejected = {r["record"]["seq"]: r for r in split.quarantined.collect()}
    assert rejected[1]["reason"] == "duplicate_record"
    assert rejected[2]["reasons"] == ["relative_humidity_2m_out_of_range"]
    assert {r["pipeline_execution_id"] for r in rejected.values()} == {"run-1"}
    assert all(r["validation_timestamp"] for r in rejected.values())


def test_invalid_first_does_not_claim_the_key(spark):
    df = _frame(spark, _with(temperature=99.0), GOOD, _with(temperature=99.0))
    got = [r["reason"] for r in judge(df, "seq").orderBy("seq").select("reason").collect()]
    assert got == ["temperature_2m_out_of_range", "", "duplicate_record"]
    assert judge(df, "seq").where(F.col("accepted")).count() == 1


def test_a_hot_key_that_nobody_claims_is_spread(spark):
    """All copies of one key break a measure rule: no valid record, yet one task must not get them all."""
    df = _frame(spark, *[_with(temperature=99.0)] * 300)
    judged = judge(df, "seq", hot_key_rows=10)
    assert {r["reason"] for r in judged.collect()} == {"temperature_2m_out_of_range"}
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "_is_hot" in plan
