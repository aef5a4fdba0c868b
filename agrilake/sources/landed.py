"""Landed API payloads and their normalisation into records.

Weather payloads lie below ``city=<city>/state=<state>/`` directories, one JSON document per file; statistics
payloads are files holding one JSON array each. Files are the unit of parallelism.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.config import AGRICULTURE_SOURCE
from agrilake.functions.numbers import nan_to_null, parse_statistic
from agrilake.schemas import (
    AGRICULTURE_RECORD,
    HOURLY_ARRAYS,
    STATISTICS_FIELDS,
    STATISTICS_PAYLOAD,
    WEATHER_PAYLOAD,
    WEATHER_RECORD,
)

#: Where a statistics row was delivered: later files, and later rows of a file, are newer.
DELIVERY = ["payload_file", "payload_row"]
#: What tells one delivery of a file from another.
FILE = ["payload_file", "payload_modified", "payload_size"]
UNREADABLE_OR_PAYLOAD = T.StructType([*WEATHER_PAYLOAD.fields, T.StructField("unreadable", T.StringType())])


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """FILE of everything below ``path``, from the file listing; contents are not read.

    An empty file is taken as still to be delivered, as Spark's readers give no row for it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(*_file_columns()).where(F.col("payload_size") > 0)


def _file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("payload_file"),
        F.unix_micros("_metadata.file_modification_time").alias("payload_modified"),
        F.col("_metadata.file_size").alias("payload_size"),
    ]


def _texts(spark: SparkSession, path: str, schema: str, modified_from: int | None, **options: bool) -> DataFrame:
    """Whole files as ``value``; those modified before ``modified_from`` (microseconds) are left out of the scan."""
    texts = spark.read.schema(schema).text(path, wholetext=True, **options)
    if modified_from is not None:
        texts = texts.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(modified_from)))
    return texts.select("*", *_file_columns())


def parsed_payloads(texts: DataFrame) -> DataFrame:
    """``value`` parsed as a weather payload; ``unreadable`` is the text if it is none, and its fields are null then."""
    parsed = F.from_json("value", UNREADABLE_OR_PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"})
    broken = F.trim("value").isin("", "null") | F.col("_p.unreadable").isNotNull() | F.col("_p").isNull()
    fields = [F.when(~broken, F.col(f"_p.{name}")).alias(name) for name in WEATHER_PAYLOAD.fieldNames()]
    rows = texts.withColumn("_p", parsed)
    others = [c for c in texts.columns if c != "value"]
    return rows.select(*fields, *others, F.when(broken, F.coalesce("value", F.lit(""))).alias("unreadable"))


def read_weather_payloads(spark: SparkSession, path: str, modified_from: int | None = None) -> DataFrame:
    """One row per payload with its place (from the directory names), FILE, and ``unreadable`` if it is no payload."""
    return parsed_payloads(_texts(spark, path, "value string, city string, state string", modified_from))


def weather_records(
    payloads: DataFrame, locations: DataFrame, payload_order: Column | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """Parallel hourly arrays to one row per hour, with ``record_order`` giving the arrival order.

    ``time`` decides how many rows there are: a shorter or missing array reads as null, surplus values are
    ignored. Coordinates come from the payload, else from the location. Columns in ``also`` go along.
    """
    places = locations.select(
        "city",
        "state",
        "region",
        F.col("latitude").alias("_location_latitude"),
        F.col("longitude").alias("_location_longitude"),
    )
    order = F.col("payload_file") if payload_order is None else payload_order
    hours = payloads.join(places, ["city", "state"]).select(
        "*", order.alias("_payload"), F.posexplode("hourly.time").alias("_hour", "timestamp")
    )
    columns = {
        "latitude": F.coalesce("latitude", "_location_latitude"),
        "longitude": F.coalesce("longitude", "_location_longitude"),
        **{name: F.get(F.col(f"hourly.{array}"), F.col("_hour")) for array, name in HOURLY_ARRAYS.items()},
    }
    fields = [columns.get(name, F.col(name)).alias(name) for name in WEATHER_RECORD.fieldNames()]
    # Zero-padded, so that text order is array order.
    arrival = F.concat_ws("#", F.col("_payload").cast("string"), F.lpad(F.col("_hour").cast("string"), 9, "0"))
    return nan_to_null(hours.select(*fields, arrival.alias("record_order"), *also))


def read_statistics_payloads(spark: SparkSession, path: str, modified_from: int | None = None) -> DataFrame:
    """One row per payload: its ``rows`` and FILE, and ``unreadable`` if it is no JSON array."""
    texts = _texts(spark, path, "value string", modified_from, recursiveFileLookup=True)
    # a lone object would pass for an array of one
    rows = F.when(F.ltrim("value").startswith("["), F.from_json("value", STATISTICS_PAYLOAD))
    parsed = texts.withColumn("rows", rows)
    return parsed.select("rows", *FILE, F.when(F.col("rows").isNull(), F.coalesce("value", F.lit(""))).alias("unreadable"))


def statistics_rows(payloads: DataFrame) -> DataFrame:
    """Rows of statistics payloads; the first element of each array is its header, not a row."""
    rows = payloads.select("payload_file", F.posexplode("rows").alias("payload_row", "row"))
    return rows.where(F.col("payload_row") > 0).select("row.*", *DELIVERY)


def read_statistics_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all landed statistics payloads that can be read."""
    return statistics_rows(read_statistics_payloads(spark, path))


def statistics_records(rows: DataFrame, source: str = AGRICULTURE_SOURCE) -> DataFrame:
    """Named fields of the rows, and where they were delivered if the rows tell."""
    delivery = [c for c in DELIVERY if c in rows.columns]
    renamed = rows.select(*[F.col(field).alias(name) for field, name in STATISTICS_FIELDS.items()], *delivery)
    return renamed.withColumns({"value": parse_statistic(F.col("value")), "source": F.lit(source)}).select(
        *AGRICULTURE_RECORD.fieldNames(), *delivery
    )
