"""Bronze to silver: typing, validity filter, one row per record id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.functions.ids import weather_record_id
from agrilake.functions.numbers import nan_to_null

TYPED_MEASURES = [
    "latitude",
    "longitude",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation_mm",
    "rain_mm",
    "wind_speed_kmh",
    "shortwave_radiation",
    "evapotranspiration",
]


def typed_weather(bronze: DataFrame) -> DataFrame:
    """Record id from the raw values, then timestamps, dates and double measures; what does not parse is null."""
    doubles = {name: F.col(name).try_cast("double") for name in TYPED_MEASURES if name in bronze.columns}
    typed = (
        bronze.withColumns(
            {
                "weather_record_id": weather_record_id(),
                "event_timestamp": F.col("timestamp").try_cast("timestamp_ntz"),
                **doubles,
            }
        )
        .withColumn("event_date", F.to_date("event_timestamp"))
        .withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
    )
    return nan_to_null(typed)


def is_valid_weather(limits: Thresholds | None = None) -> Column:
    q = (limits or Thresholds()).quality

    def unless_missing(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(True))

    humidity = F.col("relative_humidity_2m").between(q.min_humidity_pct, q.max_humidity_pct)
    temperature = F.col("temperature_2m").between(q.min_temperature_c, q.max_temperature_c)
    return (
        F.col("event_timestamp").isNotNull()
        & (F.trim("city") != "")
        & F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
        & unless_missing(humidity)
        & unless_missing(F.col("precipitation_mm") >= q.min_precipitation_mm)
        & unless_missing(F.col("wind_speed_kmh") >= q.min_wind_speed_kmh)
        & unless_missing(temperature)
    )


def latest_per_key(df: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the newest, ties settled by the remaining columns so that a rerun picks the same row.

    row_number() = 1 lets Spark cut every map task's output to one row per key before the shuffle
    (WindowGroupLimit), so a key with a third of all rows costs no more than any other.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    window = Window.partitionBy(*key).orderBy(*newest_first, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def newest_run_first(df: DataFrame) -> list[Column]:
    runs = [c for c in ("ingestion_timestamp", "pipeline_execution_id") if c in df.columns]
    return [F.col(c).desc_nulls_last() for c in runs]


def deduplicate_weather(typed: DataFrame) -> DataFrame:
    return latest_per_key(typed, ["weather_record_id"], newest_run_first(typed))


def weather_silver(bronze: DataFrame, limits: Thresholds | None = None) -> DataFrame:
    return deduplicate_weather(typed_weather(bronze).where(is_valid_weather(limits)))
