import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrilake.config import LakeConfig
from agrilake.errors import DataValidationError
from agrilake.operators.upsert import conform
from agrilake.plans import refinement
from agrilake.plans.warehouse_load import load_gold
from agrilake.schemas import BRONZE_WEATHER, GOLD_WEATHER, SILVER_WEATHER
from agrilake.sources import lake
from agrilake.sources.reading import listed, read_layer

FIRST = dt.date(2026, 1, 1)


def _bronze(spark, config, run, stamp, rows):
    """One run of (day, city, temperature) at noon; Vera is in another state and has every fifth day only."""
    df = spark.createDataFrame(rows, "day date, city string, temperature_2m double")
    fixed = {"region": "CO", "latitude": -12.5, "longitude": -55.7, "precipitation_mm": 0.25, "source": "open_meteo"}
    records = df.withColumns({name: F.lit(value) for name, value in fixed.items()}).withColumns(
        {
            "timestamp": F.date_format("day", "yyyy-MM-dd'T'12:00"),
            "state": F.when(F.col("city") == "Vera", "MS").otherwise("MT"),
            "ingestion_timestamp": F.lit(stamp),
            "pipeline_execution_id": F.lit(run),
        }
    )
    lake.write_run(conform(records, BRONZE_WEATHER), config.layer("bronze", "weather"), FIRST, run)


def _days(first, last, city="Sorriso", step=1):
    return [(FIRST + dt.timedelta(days=d), city, 20.0 + d % 9) for d in range(first, last, step)]


def _rows(spark, config, layer, schema):
    path = config.layer(*layer)
    return sorted(tuple(map(repr, r)) for r in read_layer(spark, path, schema).collect())


def _written(spark, path):
    return {r["path"]: r["modificationTime"] for r in listed(spark, path).select("path", "modificationTime").collect()}


def _changed_months(spark, path, before):
    fresh = set(_written(spark, path)) - set(before)
    return {tuple(int(part.split("=")[1]) for part in name.split("/")[-4:-2]) for name in fresh}


def test_new_runs_touch_their_months_and_equal_a_rebuild(spark, tmp_path):
    config = LakeConfig(str(tmp_path / "lake"), strict=True)
    _bronze(spark, config, "run-1", "2026-07-01", _days(0, 181) + _days(0, 181, "Vera", 5))
    first = refinement.refine_weather(spark, config)
    assert first == {"silver": 218, "gold": 218}
    assert load_gold(spark, config) == 218
    assert refinement.refine_weather(spark, config) == {"silver": 0, "gold": 0}
    assert load_gold(spark, config) == 0

    # Late days in February, one of them delivered again; 29 rows on from there are in March for the daily city.
    silver, gold = config.layer("silver", "weather"), config.layer("gold", "weather_daily")
    silver_before, gold_before = _written(spark, silver), _written(spark, gold)
    late = [(dt.date(2026, 2, 27), "Sorriso", 39.0), (dt.date(2026, 2, 26), "Lucas", 12.0)]
    _bronze(spark, config, "run-2", "2026-07-02", late[:1])
    refinement.refine_weather(spark, config)
    assert _changed_months(spark, silver, silver_before) == {(2026, 2)}
    assert _changed_months(spark, gold, gold_before) == {(2026, 2), (2026, 3)}
    loaded = load_gold(spark, config)
    assert loaded == 59 + sum(1 for day, _, _ in _days(0, 181, "Vera", 5) if day.month in (2, 3))

    # A city with every fifth day: its frames reach over all later months.
    gold_before = _written(spark, gold)
    _bronze(spark, config, "run-3", "2026-07-03", [(dt.date(2026, 3, 3), "Vera", 1.0)] + late[1:])
    refinement.refine_weather(spark, config)
    assert _changed_months(spark, gold, gold_before) == {(2026, m) for m in (2, 3, 4, 5, 6)}

    kept = {layer: _rows(spark, config, *layer) for layer in [(("silver", "weather"), SILVER_WEATHER), (("gold", "weather_daily"), GOLD_WEATHER)]}
    refinement.refine_weather(spark, config, whole=True)
    for layer, rows in kept.items():
        assert rows == _rows(spark, config, *layer)


def test_a_broken_refinement_is_followed_by_a_rebuild(spark, tmp_path, monkeypatch):
    config = LakeConfig(str(tmp_path / "lake"), strict=True)
    _bronze(spark, config, "run-1", "2026-07-01", _days(0, 40))
    refinement.refine_weather(spark, config)
    _bronze(spark, config, "run-2", "2026-07-02", _days(40, 45))
    monkeypatch.setattr(refinement, "gold_of", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refinement.refine_weather(spark, config)
    monkeypatch.undo()
    assert refinement.refine_weather(spark, config) == {"silver": 45, "gold": 45}
    assert refinement.refine_weather(spark, config) == {"silver": 0, "gold": 0}


def test_a_failed_gate_leaves_the_layers_and_the_run_waiting(spark, tmp_path):
    config = LakeConfig(str(tmp_path / "lake"), strict=True)
    _bronze(spark, config, "run-1", "2026-07-01", _days(0, 3))
    refinement.refine_weather(spark, config)
    before = _written(spark, config.layer("silver", "weather"))
    _bronze(spark, config, "run-2", "2026-07-02", [(dt.date(2026, 1, 5), "Sorriso", 900.0)])
    with pytest.raises(DataValidationError):
        refinement.refine_weather(spark, config)
    assert _written(spark, config.layer("silver", "weather")) == before
    with pytest.raises(DataValidationError):
        refinement.refine_weather(spark, config)


def test_blocks():
    assert refinement.blocks({202601, 202603, 202604}, [202601, 202602, 202603, 202604]) == [[202601], [202603, 202604]]
    assert refinement.blocks({202601, 202604}, [202601, 202604]) == [[202601, 202604]]
