import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrilake.schemas import BRONZE_AGRICULTURE, PIPELINE_STATE
from agrilake.sources import lake
from agrilake.sources.metadata import MetadataStore, PipelineState
from agrilake.sources.reading import read_files, read_layer, unite, updated_at

DAY = dt.date(2026, 8, 15)


def test_a_run_replaces_only_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "bronze")
    lake.write_run(spark.range(3), path, DAY, "a")
    lake.write_run(spark.range(5), path, DAY, "b")
    lake.write_run(spark.range(2), path, DAY, "a")
    rows = spark.read.parquet(path)
    assert {r["run"]: r["count"] for r in rows.groupBy("run").count().collect()} == {"a": 2, "b": 5}


def test_statistics_year_survives_the_directory_layout(spark, tmp_path):
    path = str(tmp_path / "bronze")
    records = spark.createDataFrame([("2024", "ibge_pam")], "year string, source string")
    stamped = lake.stamp_agriculture(records, "run-1")
    lake.write_run(stamped, path, DAY, "run-1")
    row = read_files(spark, path, BRONZE_AGRICULTURE).first()
    assert (row["year"], row["source"], row["data_source"]) == ("2024", "ibge_pam", "ibge_pam")
    assert row["pipeline_execution_id"] == "run-1" and row["ingestion_timestamp"].startswith("20")
    assert read_layer(spark, path, BRONZE_AGRICULTURE).first()["year"] == "2024"


def test_stamp_weather(spark):
    row = lake.stamp_weather(spark.range(1), "run-1").first()
    assert (row["source"], row["pipeline_execution_id"]) == ("open_meteo", "run-1")
    assert dt.datetime.fromisoformat(row["ingestion_timestamp"])


def test_missing_datasets_read_as_empty(spark, tmp_path):
    assert read_layer(spark, str(tmp_path / "no"), BRONZE_AGRICULTURE).count() == 0
    assert read_files(spark, str(tmp_path / "no")).columns == []
    assert updated_at(spark, str(tmp_path / "no")).first()["updated_at"] is None


def test_files_unite_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "k=1"))
    spark.createDataFrame([("y", 2.0)], "b string, c double").write.parquet(str(tmp_path / "k=2" / "deep"))
    rows = {(r["a"], r["b"], r["c"]) for r in read_files(spark, str(tmp_path)).collect()}
    assert rows == {(1, "x", None), (None, "y", 2.0)}
    assert updated_at(spark, str(tmp_path)).first()["updated_at"] is not None


def test_unite(spark):
    left, right = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("b",)], "b string")
    assert {tuple(r) for r in unite(left, right).collect()} == {(1, None), (None, "b")}


def test_monthly_layout_replaces_months_and_counts(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = spark.range(10).select("id", F.lit(2024).alias("year"), (F.col("id") % 2 + 1).cast("int").alias("month"), F.lit("MT").alias("state"))
    assert lake.write_by_month(rows, path) == 10
    assert lake.write_by_month(rows.where("month = 1").limit(2), path) == 2
    assert {r["month"]: r["count"] for r in spark.read.parquet(path).groupBy("month").count().collect()} == {1: 2, 2: 5}
    lake.append_by_month(rows.where("month = 1"), path)
    assert spark.read.parquet(path).where("month = 1").count() == 7


def test_whole_quarantine_and_csv(spark, tmp_path):
    assert lake.write_whole(spark.range(4), str(tmp_path / "w")) == 4
    assert lake.write_whole(spark.range(2), str(tmp_path / "w")) == 2
    rejected = spark.createDataFrame([((1,), "r")], "record struct<a:int>, reason string")
    for run in ("a", "a", "b"):
        lake.write_quarantine(rejected, str(tmp_path / "q"), run)
    assert spark.read.json(str(tmp_path / "q")).count() == 2
    lake.write_quarantine(rejected.limit(0), str(tmp_path / "none"), "a")
    assert not list((tmp_path / "none").glob("**/*.json"))
    table = spark.createDataFrame([("x", 1)], "`Temp. media` string, UF int").coalesce(1)
    lake.write_csv(table, str(tmp_path / "c"))
    files = list((tmp_path / "c").glob("*.csv"))
    assert [f.read_text().splitlines() for f in files] == [["Temp. media,UF", "x,1"]]


@pytest.fixture
def store(spark, tmp_path):
    return MetadataStore(spark, str(tmp_path / "metadata"))


def test_state_defaults_and_last_write_wins(store):
    assert store.load("weather", "s") == PipelineState("weather", "s")
    assert store.load("weather", "s").status == "never_run"
    store.record_success("weather", "s", DAY, 10, 1.5)
    store.record_success("weather", "s", dt.date(2026, 8, 16), 20, 2.5)
    store.record_success("crops", "s", DAY, 1, 0.5)
    state = store.load("weather", "s")
    assert (state.last_ingested_date, state.records_processed, state.status) == ("2026-08-16", 20, "success")
    assert store.states().count() == 2 and store.states().columns == PIPELINE_STATE.fieldNames()


def test_status_keeps_the_last_five_runs(store):
    assert store.status() == {"pipelines": [], "recent_runs": [], "pipeline_count": 0, "recent_run_count": 0}
    store.record_success("weather", "s", DAY, 10, 1.5)
    for i in range(6):
        store.append_run(str(i), finished_at=f"2026-08-15T00:00:0{i}", status="success")
    status = store.status()
    assert (status["pipeline_count"], status["recent_run_count"]) == (1, 5)
    assert [r["pipeline_execution_id"] for r in status["recent_runs"]] == ["1", "2", "3", "4", "5"]


def test_dataset_metrics(store):
    store.append_dataset_metric("run-1", "weather", "bronze", 9, records_rejected=3)
    row = store.dataset_metrics().first()
    assert (row["layer"], row["records"], row["status"], row["extra"]) == ("bronze", 9, "success", {"records_rejected": "3"})


def test_staging_goes_to_the_shared_folder_of_the_cluster():
    from types import SimpleNamespace

    from agrilake.config import LakeConfig

    def session(settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))

    config = LakeConfig("/lake/")
    assert config.staging_root(session({})) == "/lake/_staging"
    assert config.staging_root(session({"spark.checkpoint.dir": "hdfs://shared/points/"})) == "hdfs://shared/points"
