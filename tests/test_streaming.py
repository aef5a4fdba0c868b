import datetime as dt

from pyspark.sql import functions as F

from agrilake.schemas import BRONZE_WEATHER
from agrilake.operators.silver import weather_silver
from agrilake.sources import lake
from agrilake.sources.reading import read_layer
from agrilake.operators.upsert import conform
from agrilake.streaming.silver import merge_records, start_silver_stream


def _bronze(spark, *rows, run="r1"):
    df = spark.createDataFrame(
        [(f"2026-08-{day:02d}T00:00", city, "MT", "CO", 1.0, 2.0, temperature) for day, city, temperature in rows],
        "timestamp string, city string, state string, region string, latitude double, longitude double, temperature_2m double",
    )
    stamps = {"ingestion_timestamp": F.lit(f"2026-08-03T00:00:0{run[1]}"), "pipeline_execution_id": F.lit(run)}
    return conform(df.withColumns(stamps), BRONZE_WEATHER)


def test_stream_keeps_the_newest_run_of_each_record(spark, tmp_path):
    bronze, silver, marks = (str(tmp_path / name) for name in ("bronze", "silver", "checkpoint"))

    def run():
        query = start_silver_stream(spark, bronze, silver, marks)
        query.awaitTermination()
        assert query.exception() is None
        return sorted((r["city"], r["temperature_2m"]) for r in spark.read.parquet(silver).collect())

    lake.write_run(_bronze(spark, (1, "A", 20.0), (1, "A", 20.0), (1, "bad", 99.0)), bronze, dt.date(2026, 8, 1), "r1")
    assert run() == [("A", 20.0)]
    lake.write_run(_bronze(spark, (1, "A", 25.0), (2, "B", 21.0), run="r2"), bronze, dt.date(2026, 8, 2), "r2")
    assert run() == [("A", 25.0), ("B", 21.0)]
    assert run() == [("A", 25.0), ("B", 21.0)]
    whole = weather_silver(read_layer(spark, bronze, BRONZE_WEATHER))
    assert sorted((r["city"], r["temperature_2m"]) for r in whole.collect()) == run()


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    silver = str(tmp_path / "silver")
    for _ in range(2):
        merge_records(_bronze(spark, (1, "A", 20.0), (31, "A", 21.0)), silver)
    assert spark.read.parquet(silver).count() == 2
