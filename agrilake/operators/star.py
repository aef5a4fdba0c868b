"""Star schema: staging projection, dimensions, facts and the joined read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrilake.config import AGRICULTURE_SOURCE, WEATHER_SOURCE
from agrilake.functions.calendar import calendar_columns, date_id
from agrilake.functions.ids import hashed_id, packed_id
from agrilake.functions.numbers import nan_to_null
from agrilake.operators.upsert import insert_if_absent, orphan_keys, refuse, refuse_repeated, upsert
from agrilake.schemas import (
    AGRICULTURE_FACT_MEASURES,
    DIM_CROP,
    DIM_DATE,
    DIM_LOCATION,
    DIM_SOURCE,
    FACT_AGRICULTURE,
    FACT_WEATHER,
    WEATHER_FACT_MEASURES,
)

# Fixed values of the source dimension.
WEATHER_SOURCE_TYPE, AGRICULTURE_SOURCE_TYPE = "weather_api", "agriculture_statistics"
SEED_SOURCE = (WEATHER_SOURCE, WEATHER_SOURCE_TYPE)

WEATHER_FACT_KEY = ["date_id", "location_id", "source_id"]
AGRICULTURE_FACT_KEY = ["year", "state_code", "crop_id", "source_id"]
LOCATION_KEY = ["city", "state"]


def _source_or(df: DataFrame, default: str) -> Column:
    return F.coalesce(F.col("source"), F.lit(default)) if "source" in df.columns else F.lit(default)


def _measures(df: DataFrame, kinds: dict) -> list[Column]:
    return [
        (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()
    ]


def weather_staging(gold: DataFrame) -> DataFrame:
    """Gold rows in the warehouse's names, types and precision (decimals round half up, NaN is null)."""
    clean = nan_to_null(gold)
    coordinates = [F.col(c).cast("decimal(9,6)").alias(c) for c in ("latitude", "longitude")]
    day = F.to_date("event_date")
    return clean.select(
        date_id(day).alias("date_id"),
        day.alias("event_date"),
        *LOCATION_KEY,
        "region",
        *coordinates,
        _source_or(clean, WEATHER_SOURCE).alias("source"),
        *_measures(clean, WEATHER_FACT_MEASURES),
    )


def agriculture_staging(gold: DataFrame) -> DataFrame:
    clean = nan_to_null(gold).withColumnsRenamed({"territory_code": "state_code", "territory_name": "state_name"})
    return clean.select(
        F.col("year").cast("int").alias("year"),
        "state_code",
        "product_code",
        "product_name",
        _source_or(clean, AGRICULTURE_SOURCE).alias("source"),
        *_measures(clean, AGRICULTURE_FACT_MEASURES),
    )


def date_rows(staging: DataFrame) -> DataFrame:
    return staging.select(F.col("event_date").alias("full_date")).distinct().select(
        *[column.alias(name) for name, column in calendar_columns(F.col("full_date")).items()]
    )


def location_rows(staging: DataFrame) -> DataFrame:
    return staging.select(*LOCATION_KEY, "region", "latitude", "longitude").distinct()


def source_rows(staging: DataFrame, source_type: str) -> DataFrame:
    return staging.select(F.col("source").alias("source_name")).distinct().withColumn("source_type", F.lit(source_type))


def crop_rows(staging: DataFrame) -> DataFrame:
    """One name per crop code; a batch that spells a crop in two ways gets the alphabetically last one."""
    return staging.groupBy(F.col("product_code").alias("crop_code")).agg(F.max("product_name").alias("crop_name"))


def merge_dates(current: DataFrame, staging: DataFrame) -> DataFrame:
    return insert_if_absent(current, date_rows(staging), ["date_id"], DIM_DATE)


def merge_locations(current: DataFrame, staging: DataFrame) -> DataFrame:
    replaced = ["region", "latitude", "longitude"]
    rows = refuse_ambiguous_locations(staging)
    return upsert(current, rows, LOCATION_KEY, replaced, DIM_LOCATION, "location_id")


def merge_sources(current: DataFrame, staging: DataFrame, source_type: str) -> DataFrame:
    rows = source_rows(staging, source_type)
    return insert_if_absent(current, rows, ["source_name"], DIM_SOURCE, "source_id")


def merge_crops(current: DataFrame, staging: DataFrame) -> DataFrame:
    return upsert(current, crop_rows(staging), ["crop_code"], ["crop_name"], DIM_CROP, "crop_id")


def refuse_incomplete_locations(staging: DataFrame) -> DataFrame:
    """``staging``, which ends the job at a row without day or location part, or whose state is no two-letter code."""
    required = ["event_date", *LOCATION_KEY, "region", "latitude", "longitude"]
    checked = {
        name: F.coalesce(F.col(name), refuse(f"dim_location: row without {name}:", *required)) for name in required
    }
    long_state = refuse("dim_location: state is no two-letter code:", "state")
    return staging.withColumns(checked).withColumn(
        "state", F.when(F.length("state") <= 2, F.col("state")).otherwise(long_state)
    )


def refuse_incomplete_crops(staging: DataFrame) -> DataFrame:
    """``staging``, which ends the job at a row without year, territory or crop, or with a crop that has no name."""
    required = [*AGRICULTURE_FACT_KEY[:2], "product_code", "product_name"]
    return staging.withColumns(
        {name: F.coalesce(F.col(name), refuse(f"dim_crop: row without {name}:", *required)) for name in required}
    )


def refuse_ambiguous_locations(staging: DataFrame) -> DataFrame:
    """One row per city and state; a second region or coordinate ends the job."""
    place = F.struct("region", "latitude", "longitude")
    found = staging.groupBy(*LOCATION_KEY).agg(F.min(place).alias("_least"), F.max(place).alias("_place"))
    same = F.when(F.col("_least") == F.col("_place"), F.col("_place")).otherwise(
        refuse("dim_location: more than one row for", *LOCATION_KEY)
    )
    return found.select(*LOCATION_KEY, same.alias("_place")).select(*LOCATION_KEY, "_place.*")


def _found(key: str, *looked_up: str) -> Column:
    """A foreign key that has to be there: a staged row without its dimension row ends the job."""
    return F.coalesce(F.col(key), refuse(f"no {key} for", *looked_up)).alias(key)


def weather_fact_rows(staging: DataFrame, locations: DataFrame, sources: DataFrame, loaded_at: Column) -> DataFrame:
    """Staging with its dimension keys. No join hints: dimensions grow, so Spark picks by measured size."""
    keyed = staging.join(locations.select("location_id", *LOCATION_KEY), LOCATION_KEY, "left").join(
        sources.select("source_id", F.col("source_name").alias("source")), "source", "left"
    )
    keys = ["date_id", _found("location_id", *LOCATION_KEY), _found("source_id", "source")]
    return keyed.select(*keys, *WEATHER_FACT_MEASURES, loaded_at.alias("loaded_at"))


def agriculture_fact_rows(staging: DataFrame, crops: DataFrame, sources: DataFrame, loaded_at: Column) -> DataFrame:
    keyed = staging.join(crops.select("crop_id", F.col("crop_code").alias("product_code")), "product_code", "left").join(
        sources.select("source_id", F.col("source_name").alias("source")), "source", "left"
    )
    keys = ["year", "state_code", _found("crop_id", "product_code"), _found("source_id", "source")]
    return keyed.select(*keys, *AGRICULTURE_FACT_MEASURES, loaded_at.alias("loaded_at"))


def merge_weather_facts(current: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert of a batch; its id is the fact's key: eight digits of the day, up to 2^28 locations, 2^8 sources."""
    new_id = packed_id(("date_id", 27), ("location_id", 28), ("source_id", 8))
    batch = refuse_repeated(rows, WEATHER_FACT_KEY, "fact_weather_daily")
    return upsert(
        current, batch, WEATHER_FACT_KEY, list(WEATHER_FACT_MEASURES), FACT_WEATHER, "weather_fact_id", new_id
    )


def merge_agriculture_facts(current: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert of a batch; territory codes are text, so the id is a hash, to be checked where the rows are written."""
    new_id = hashed_id(*AGRICULTURE_FACT_KEY)
    measures = list(AGRICULTURE_FACT_MEASURES)
    batch = refuse_repeated(rows, AGRICULTURE_FACT_KEY, "fact_agriculture_production")
    return upsert(
        current, batch, AGRICULTURE_FACT_KEY, measures, FACT_AGRICULTURE, "agriculture_fact_id", new_id
    )


def foreign_key_report(fact: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """(foreign_key, orphan_rows) for every referenced dimension."""
    parts = [
        orphan_keys(fact, dimension, key).agg(
            F.lit(key).alias("foreign_key"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")
        )
        for key, dimension in references.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def read_star(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """The reporting view of the weather star: one row per fact row; exports order it, see ``in_day_order``."""
    return (
        fact.join(dates.select("date_id", "full_date"), "date_id")
        .join(locations, "location_id")
        .select("full_date", *LOCATION_KEY, "region", "latitude", "longitude", *WEATHER_FACT_MEASURES)
    )


def in_day_order(readings: DataFrame) -> DataFrame:
    """The star read as it is handed out."""
    return readings.orderBy("full_date", "city")
