import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from agrilake.config import LakeConfig
from agrilake.errors import DataValidationError
from agrilake.plans import jobs
from agrilake.plans.warehouse_load import read_readings
from agrilake.sources.metadata import MetadataStore
from agrilake.sources.warehouse import Warehouse

TODAY = dt.date(2026, 8, 3)


def _land_weather(root, day, temperatures, city="Sorriso", state="MT"):
    target = root / "weather" / f"city={city}" / f"state={state}"
    target.mkdir(parents=True, exist_ok=True)
    times = [f"{day}T{hour:02d}:00" for hour in range(len(temperatures))]
    hourly = {"time": times, "temperature_2m": temperatures, "precipitation": [0.5] * len(times)}
    payload = {"latitude": -12.5, "longitude": -55.7, "hourly": hourly}
    (target / f"{day}.json").write_text(json.dumps(payload))


def _land_crops(root, **values):
    target = root / "crops"
    target.mkdir(parents=True, exist_ok=True)
    row = {"D1C": "51", "D1N": "Mato Grosso", "D2N": "m", "D3C": "2713", "D3N": "Soja", "D4C": "2024", "MN": "t"}
    metrics = {"214": "1000", "215": "3000", "216": "250", "112": "4000", **values}
    rows = [{**row, "D2C": code, "V": value} for code, value in metrics.items()]
    rows.append({**row, "D2C": "214", "D3C": "9999", "V": "5"})  # a crop nobody asked for
    (target / "pam.json").write_text(json.dumps([{"D1C": "header"}, *rows]))


@pytest.fixture
def lake(tmp_path):
    landing = tmp_path / "landing"
    _land_weather(landing, "2026-08-02", [20.0, 99.0, 22.0])
    _land_weather(landing, "2026-08-03", [30.0])
    _land_weather(landing, "2026-07-30", [10.0])  # before the first day to ingest
    _land_crops(landing)
    return landing, LakeConfig(str(tmp_path / "lake"), strict=True)


def test_whole_run(spark, lake):
    landing, config = lake
    result = jobs.run_all(spark, config, str(landing / "weather"), str(landing / "crops"), TODAY)
    assert result["weather_ingestion"] == {
        "records_extracted": 4, "records_valid": 3, "records_rejected": 1, "last_ingested_date": "2026-08-03",
    }
    assert result["agriculture_ingestion"]["records_extracted"] == 4
    assert result["weather"] == {"silver": 3, "gold": 2}
    assert result["agriculture"] == {"silver": 4, "gold": 1}
    assert result["rows_loaded"] == 3

    rejected = spark.read.json(config.layer("quarantine", "weather")).first()
    assert rejected["reason"] == "temperature_2m_out_of_range" and rejected["record"]["temperature_2m"] == 99.0
    readings, origin = read_readings(spark, config)
    temperatures = {r["full_date"].day: float(r["avg_temperature"]) for r in readings.collect()}
    assert origin == "warehouse" and temperatures == {2: 21.0, 3: 30.0}
    crop = Warehouse(spark, config.warehouse_root).read("fact_agriculture_production").first()
    assert float(crop["calculated_yield_t_ha"]) == 4.0

    store = MetadataStore(spark, config.metadata_root)
    assert store.status()["recent_run_count"] == 1 and store.status()["pipeline_count"] == 2
    layers = {(r["dataset"], r["layer"]): r["records"] for r in store.dataset_metrics().collect()}
    assert layers == {
        ("weather", "bronze"): 3, ("weather", "silver"): 3, ("weather", "gold"): 2,
        ("agriculture", "silver"): 4, ("agriculture", "gold"): 1,
    }

    # The next run starts the day after; a rerun on the same day has nothing to do.
    again = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-x", TODAY)
    assert again == {"records_extracted": 0, "last_ingested_date": "2026-08-03"}
    _land_weather(landing, "2026-08-04", [25.0, 26.0])
    later = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-y", dt.date(2026, 8, 4))
    assert later["records_valid"] == 2
    assert jobs.refine_weather(spark, config) == {"silver": 5, "gold": 3}


def test_late_early_and_unplaced_files(spark, lake):
    landing, config = lake
    ingest = lambda run, day=TODAY: jobs.ingest_weather(spark, config, str(landing / "weather"), run, day)
    assert ingest("run-1")["records_extracted"] == 4
    _land_weather(landing, "2026-08-01", [18.0])  # landed after its day had been ingested
    _land_weather(landing, "2026-08-04", [25.0])  # a day still to come
    _land_weather(landing, "2026-08-02", [18.0], city="Nowhere", state="XX")
    assert ingest("run-2")["records_extracted"] == 1
    assert ingest("run-3")["records_extracted"] == 0
    assert ingest("run-4", dt.date(2026, 8, 4))["records_extracted"] == 1
    known = spark.createDataFrame([("Nowhere", "XX", "Norte", -1.0, -50.0)], "city string, state string, region string, latitude double, longitude double")
    found = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-5", TODAY, known)
    assert found["records_extracted"] == 1
    assert spark.read.parquet(config.layer("bronze", "weather")).count() == 6


def _bronze_rows(spark, config, dataset="weather"):
    return spark.read.option("recursiveFileLookup", True).parquet(config.layer("bronze", dataset)).count()


def test_a_broken_payload_does_not_stop_the_others(spark, lake):
    landing, config = lake
    target = landing / "weather" / "city=Sorriso" / "state=MT"
    (target / "broken.json").write_text('{"hourly": {"time": ["2026-08-02T')
    (landing / "crops" / "broken.json").write_text('[{"D1C": ')
    found = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-1", TODAY)
    assert (found["records_extracted"], found["records_valid"], found["records_rejected"]) == (5, 3, 2)
    kept = spark.read.json(config.layer("quarantine", "weather_payloads")).first()
    assert kept["reason"] == "unreadable_payload" and kept["payload"].endswith("2026-08-02T") and kept["run"] == "run-1"
    crops = jobs.ingest_agriculture(spark, config, str(landing / "crops"), "run-1", TODAY)
    assert crops["records_extracted"] == 4 and crops["payloads_rejected"] == 1
    again = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-2", TODAY)
    assert again["records_extracted"] == 0
    (target / "broken.json").write_text(json.dumps({"hourly": {"time": ["2026-08-02T05:00"], "temperature_2m": [19.0]}}))
    mended = jobs.ingest_weather(spark, config, str(landing / "weather"), "run-3", TODAY)
    assert (mended["records_extracted"], mended["records_valid"]) == (1, 1)


def test_only_new_and_redelivered_files_are_read(spark, lake):
    landing, config = lake
    weather, crops = str(landing / "weather"), str(landing / "crops")
    jobs.ingest_weather(spark, config, weather, "run-1", TODAY)
    jobs.ingest_agriculture(spark, config, crops, "run-1", TODAY)
    rows = _bronze_rows(spark, config), _bronze_rows(spark, config, "agriculture")
    assert jobs.ingest_agriculture(spark, config, crops, "run-2", TODAY)["records_extracted"] == 0
    assert rows == (_bronze_rows(spark, config), _bronze_rows(spark, config, "agriculture"))
    # contents of what is done with are not even opened
    old = landing / "weather" / "city=Sorriso" / "state=MT" / "2026-07-30.json"
    stamp = old.stat()
    old.write_bytes(b"x" * stamp.st_size)
    os.utime(old, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    _land_weather(landing, "2026-08-02", [20.0, 21.0, 22.0, 23.0])  # corrected under its name
    found = jobs.ingest_weather(spark, config, weather, "run-3", TODAY)
    assert (found["records_extracted"], found["records_valid"]) == (4, 4)
    jobs.refine_weather(spark, config)
    silver = spark.read.parquet(config.layer("silver", "weather")).where("event_date = '2026-08-02'")
    assert sorted(r["temperature_2m"] for r in silver.collect()) == [20.0, 21.0, 22.0, 23.0]


def test_days_to_come_are_taken_once(spark, lake):
    landing, config = lake
    target = landing / "weather" / "city=Sorriso" / "state=MT"
    times = ["2026-08-03T05:00", "no time", "2026-08-04T05:00"]
    (target / "forecast.json").write_text(json.dumps({"hourly": {"time": times, "temperature_2m": [1.0, 2.0, 3.0]}}))
    ingest = lambda run, day: jobs.ingest_weather(spark, config, str(landing / "weather"), run, day)
    assert ingest("run-1", TODAY)["records_extracted"] == 6
    assert ingest("run-2", TODAY)["records_extracted"] == 0
    assert ingest("run-3", dt.date(2026, 8, 4))["records_extracted"] == 1
    assert ingest("run-4", dt.date(2026, 8, 5))["records_extracted"] == 0
    assert _bronze_rows(spark, config) == 6


def test_last_delivered_statistic_wins(spark, lake):
    landing, config = lake
    again = [{"D1C": "51", "D1N": "Mato Grosso", "D2N": "m", "D2C": "214", "D3C": "2713", "D3N": "Soja", "D4C": "2024", "MN": "t", "V": v} for v in ("950", "900")]
    (landing / "crops" / "pam2.json").write_text(json.dumps([{"D1C": "header"}, *again]))
    jobs.ingest_agriculture(spark, config, str(landing / "crops"), "run-1", TODAY)
    jobs.refine_agriculture(spark, config)
    silver = spark.read.parquet(config.layer("silver", "agriculture"))
    assert [r["value"] for r in silver.where("metric_code = '214'").collect()] == [900.0]


def test_strict_and_lenient_runs(spark, lake, tmp_path):
    landing, config = lake
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        jobs.run_all(spark, config, str(landing / "weather"), str(landing / "nowhere"), TODAY)
    lenient = LakeConfig(str(tmp_path / "lenient"))
    result = jobs.run_all(spark, lenient, str(landing / "weather"), str(landing / "nowhere"), TODAY)
    assert "agriculture" not in result and result["rows_loaded"] == 2


def test_failed_gate_stops_the_later_layers(spark, tmp_path):
    config = LakeConfig(str(tmp_path))
    landing = tmp_path / "landing"
    _land_weather(landing, "2026-08-02", [20.0])
    jobs.ingest_weather(spark, config, str(landing / "weather"), "run-1", TODAY)
    bronze = config.layer("bronze", "weather")
    bad = spark.read.parquet(bronze).withColumn("latitude", F.lit(99.0)).withColumn("run", F.lit("run-2"))
    bad.write.mode("append").partitionBy("ingest_date", "run").parquet(bronze)
    with pytest.raises(DataValidationError, match="latitude"):
        jobs.refine_weather(spark, config)
    assert not (tmp_path / "silver").exists()


def test_date_range():
    assert jobs.next_date(None, TODAY) == TODAY
    assert jobs.next_date("2026-08-31", TODAY) == dt.date(2026, 9, 1)
