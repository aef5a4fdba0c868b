"""Column contracts of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def _all(kind: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(name, kind) for name in names]


# Payload array -> record column.
HOURLY_ARRAYS = {
    "temperature_2m": "temperature_2m",
    "relative_humidity_2m": "relative_humidity_2m",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_10m",
    "surface_pressure": "surface_pressure_hpa",
    "soil_temperature_0_to_7cm": "soil_temperature_0_to_7cm",
    "soil_moisture_0_to_7cm": "soil_moisture_0_to_7cm",
    "shortwave_radiation": "shortwave_radiation",
    "et0_fao_evapotranspiration": "evapotranspiration",
}

WEATHER_PAYLOAD = _struct(
    ("latitude", _D),
    ("longitude", _D),
    (
        "hourly",
        _struct(("time", T.ArrayType(_S)), *[(name, T.ArrayType(_D)) for name in HOURLY_ARRAYS]),
    ),
)

# Statistics payload field -> record column.
STATISTICS_FIELDS = {
    "D1C": "territory_code",
    "D1N": "territory_name",
    "D2C": "metric_code",
    "D2N": "metric_name",
    "D3C": "product_code",
    "D3N": "product_name",
    "D4C": "year",
    "V": "value",
    "MN": "unit",
}
STATISTICS_PAYLOAD = T.ArrayType(_struct(*_all(_S, *STATISTICS_FIELDS)))

LOCATIONS = _struct(("city", _S), ("state", _S), ("latitude", _D), ("longitude", _D), ("region", _S))
PRODUCTS = _struct(*_all(_S, "source", "source_table", "product_code", "product_name", "crop_type"))

WEATHER_RECORD = _struct(
    *_all(_S, "timestamp", "city", "state", "region"),
    *_all(_D, "latitude", "longitude"),
    *_all(_D, *HOURLY_ARRAYS.values()),
)
_RUN_COLUMNS = _all(_S, "ingestion_timestamp", "source", "pipeline_execution_id")
BRONZE_WEATHER = T.StructType(WEATHER_RECORD.fields + _struct(*_RUN_COLUMNS).fields)

AGRICULTURE_RECORD = _struct(
    *_all(_S, "territory_code", "territory_name", "metric_code", "metric_name", "product_code", "product_name"),
    ("year", _S),
    ("value", _D),
    *_all(_S, "unit", "source"),
)
BRONZE_AGRICULTURE = T.StructType(
    AGRICULTURE_RECORD.fields
    + _struct(
        *_all(_S, "data_source", "ingestion_timestamp", "pipeline_execution_id", "payload_file"), ("payload_row", _I)
    ).fields
)

SILVER_WEATHER = T.StructType(
    BRONZE_WEATHER.fields
    + _struct(
        ("weather_record_id", _S),
        ("event_timestamp", T.TimestampNTZType()),
        ("event_date", T.DateType()),
        ("year", _I),
        ("month", _I),
    ).fields
)
SILVER_AGRICULTURE = _struct(
    ("year", _I),
    *_all(_S, "territory_code", "territory_name", "metric_code", "metric_name", "product_code", "product_name"),
    ("value", _D),
    *_all(_S, "unit", "data_source", "ingestion_timestamp", "pipeline_execution_id"),
)

DAILY_KEYS = ["event_date", "city", "state", "region", "latitude", "longitude", "source"]
# Daily measure -> (aggregate, hourly column).
DAILY_MEASURES = {
    "avg_temperature": ("avg", "temperature_2m"),
    "max_temperature": ("max", "temperature_2m"),
    "min_temperature": ("min", "temperature_2m"),
    "total_precipitation": ("sum", "precipitation_mm"),
    "avg_humidity": ("avg", "relative_humidity_2m"),
    "avg_wind_speed": ("avg", "wind_speed_kmh"),
    "max_wind_speed": ("max", "wind_speed_kmh"),
    "solar_radiation": ("sum", "shortwave_radiation"),
    "evapotranspiration": ("sum", "evapotranspiration"),
}
ROLLING_MEASURES = [
    "precipitation_accumulated_7d",
    "precipitation_accumulated_30d",
    "avg_temperature_7d",
    "avg_temperature_30d",
]
RISK_COLUMNS = ["drought_risk", "heat_risk", "heavy_rain_risk"]

GOLD_WEATHER = _struct(
    ("event_date", T.DateType()),
    *_all(_S, "city", "state", "region"),
    *_all(_D, "latitude", "longitude"),
    ("source", _S),
    *_all(_D, *DAILY_MEASURES),
    ("is_dry_day", _I),
    ("days_without_rain", _L),
    *_all(_D, *ROLLING_MEASURES, "thermal_amplitude"),
    *_all(_S, *RISK_COLUMNS),
    ("year", _I),
    ("month", _I),
)

AGRICULTURE_KEYS = ["year", "territory_code", "territory_name", "product_code", "product_name"]
# Statistics metric code -> gold column.
AGRICULTURE_METRICS = {
    "214": "produced_quantity",
    "215": "production_value",
    "216": "harvested_area",
    "112": "reported_yield_kg_ha",
}
GOLD_AGRICULTURE = _struct(
    ("year", _I),
    *_all(_S, *AGRICULTURE_KEYS[1:]),
    *_all(_D, *AGRICULTURE_METRICS.values(), "calculated_yield_t_ha", "reported_yield_t_ha"),
    ("source", _S),
)


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# Star schema. Names and NUMERIC(p,s) of the warehouse contract.
DIM_DATE = _struct(
    ("date_id", _I),
    ("full_date", T.DateType()),
    *_all(_I, "day", "day_of_week", "week", "month"),
    ("month_name", _S),
    *_all(_I, "quarter", "year"),
    ("is_weekend", T.BooleanType()),
)
DIM_LOCATION = _struct(
    ("location_id", _L), *_all(_S, "city", "state", "region"), *_all(_dec(9, 6), "latitude", "longitude")
)
DIM_SOURCE = _struct(("source_id", _L), *_all(_S, "source_name", "source_type"))
DIM_CROP = _struct(("crop_id", _L), *_all(_S, "crop_code", "crop_name"))
WEATHER_FACT_MEASURES = {
    "avg_temperature": _dec(6, 2),
    "max_temperature": _dec(6, 2),
    "min_temperature": _dec(6, 2),
    "total_precipitation": _dec(10, 2),
    "avg_humidity": _dec(6, 2),
    "avg_wind_speed": _dec(6, 2),
    "max_wind_speed": _dec(6, 2),
    "solar_radiation": _dec(12, 2),
    "evapotranspiration": _dec(10, 2),
    "days_without_rain": _I,
    "precipitation_accumulated_7d": _dec(10, 2),
    "precipitation_accumulated_30d": _dec(10, 2),
    "avg_temperature_7d": _dec(6, 2),
    "avg_temperature_30d": _dec(6, 2),
    "thermal_amplitude": _dec(6, 2),
    "drought_risk": _S,
    "heat_risk": _S,
    "heavy_rain_risk": _S,
}
FACT_WEATHER = _struct(
    ("weather_fact_id", _L),
    ("date_id", _I),
    ("location_id", _L),
    ("source_id", _L),
    *WEATHER_FACT_MEASURES.items(),
    ("loaded_at", T.TimestampType()),
)
AGRICULTURE_FACT_MEASURES = {
    "state_name": _S,
    "produced_quantity": _dec(18, 2),
    "production_value": _dec(18, 2),
    "harvested_area": _dec(18, 2),
    "reported_yield_kg_ha": _dec(18, 2),
    "reported_yield_t_ha": _dec(18, 4),
    "calculated_yield_t_ha": _dec(18, 4),
}
FACT_AGRICULTURE = _struct(
    ("agriculture_fact_id", _L),
    ("year", _I),
    ("state_code", _S),
    ("crop_id", _L),
    ("source_id", _L),
    *AGRICULTURE_FACT_MEASURES.items(),
    ("loaded_at", T.TimestampType()),
)

PIPELINE_STATE = _struct(
    *_all(_S, "pipeline_name", "source", "last_successful_execution", "last_ingested_date"),
    ("records_processed", _L),
    ("status", _S),
    ("execution_time", _D),
    ("saved_at", T.TimestampType()),
)
INGESTED_FILES = _struct(
    *_all(_S, "pipeline_name", "payload_file"),
    *_all(_L, "payload_modified", "payload_size"),
    ("done", T.BooleanType()),
    ("through", T.DateType()),
    ("saved_at", T.TimestampType()),
)
# How far a step is with an item (a run, a month) as it was at ``written_at``, in milliseconds.
STEP_PROGRESS = _struct(
    *_all(_S, "step", "item", "status"),
    ("written_at", _L),
    ("saved_at", T.TimestampType()),
)
RUN_LOG = _struct(
    *_all(_S, "pipeline_execution_id", "started_at", "finished_at"),
    ("duration_seconds", _D),
    *_all(_L, "records_extracted", "records_silver", "records_gold", "records_rejected"),
    ("status", _S),
)
DATASET_METRICS = _struct(
    *_all(_S, "pipeline_execution_id", "dataset", "layer"),
    ("records", _L),
    *_all(_S, "status", "measured_at"),
    ("extra", T.MapType(_S, _S)),
)

# Columns a layer must have before its gate looks at values.
BRONZE_REQUIRED = [
    "timestamp",
    "city",
    "state",
    "latitude",
    "longitude",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation_mm",
    "wind_speed_kmh",
]
SILVER_REQUIRED = [*BRONZE_REQUIRED, "weather_record_id", "event_timestamp", "event_date", "year", "month"]
GOLD_REQUIRED = [
    *DAILY_KEYS,
    "avg_temperature",
    "max_temperature",
    "min_temperature",
    "total_precipitation",
    "avg_humidity",
    "days_without_rain",
    *ROLLING_MEASURES,
    "thermal_amplitude",
    *RISK_COLUMNS,
]
GOLD_AGRICULTURE_REQUIRED = [name for name in GOLD_AGRICULTURE.fieldNames() if name != "source"]
