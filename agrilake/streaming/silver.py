"""Bronze to silver as a stream over the files of the bronze layer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from agrilake.config import Thresholds
from agrilake.operators.silver import deduplicate_weather, weather_silver
from agrilake.schemas import BRONZE_WEATHER, SILVER_WEATHER
from agrilake.sources import lake
from agrilake.sources.reading import read_layer

_PARTITION = ["year", "month", "state"]


def merge_records(bronze: DataFrame, silver_path: str, limits: Thresholds | None = None) -> None:
    """Merge a batch into silver: of all rows of a record id, in silver or in the batch, the newest run's stays.

    So a stream ends where a batch over the same bronze files ends, and replaying a batch changes nothing. Only the
    months and states of the batch are read and replaced. The merged rows are written beside silver first, as a
    dataset can't be replaced while it is read.
    """
    spark = bronze.sparkSession
    columns = SILVER_WEATHER.fieldNames()
    beside = f"{silver_path.rstrip('/')}_merging/{uuid.uuid4().hex}"
    fresh = weather_silver(bronze, limits).select(*columns)
    lake.write_whole(fresh, f"{beside}/batch")
    fresh = spark.read.schema(SILVER_WEATHER).parquet(f"{beside}/batch")
    touched = fresh.select(*_PARTITION).distinct()
    held = read_layer(spark, silver_path, SILVER_WEATHER).select(*columns).join(touched, _PARTITION, "left_semi")
    merged = deduplicate_weather(held.select(*columns).unionByName(fresh))
    lake.write_whole(merged, f"{beside}/merged")
    lake.write_by_month(spark.read.schema(SILVER_WEATHER).parquet(f"{beside}/merged"), silver_path)


def start_silver_stream(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    limits: Thresholds | None = None,
) -> StreamingQuery:
    """Process every bronze file not seen yet and stop; run it again for the next ones."""
    bronze = spark.readStream.schema(BRONZE_WEATHER).parquet(bronze_path).select(*BRONZE_WEATHER.fieldNames())

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_records(batch, silver_path, limits)

    return (
        bronze.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
