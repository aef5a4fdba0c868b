"""The driver tables seen as weather observations and crop statistics.

Measures are whole numbers or binary fractions, so sums are exact in any order and on any engine; only means of
means need rounding before two engines can be compared (``compared``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.config import DroughtRule, HeavyRainRule, Thresholds
from agrilake.operators.agriculture import agriculture_gold
from agrilake.operators.gold import weather_gold
from agrilake.operators.reports import with_risk
from agrilake.schemas import HOURLY_ARRAYS

LIMITS = Thresholds(
    drought=DroughtRule(precipitation_7d_max_mm=5, consecutive_dry_days_min=7, avg_temperature_7d_min_c=20),
    heavy_rain=HeavyRainRule(daily_precipitation_mm=5),
)
# The last territory stays unmapped on purpose.
STATE_BY_TERRITORY = {str(key): f"NATION_{key}" for key in range(24)}
FIRST_BATCH_END = dt.date(2024, 1, 20)
SECOND_BATCH_START = dt.date(2024, 1, 15)
SHARED_YEAR = 1995  # the year that both loads of crop statistics bring


# The columns used here, so that no read has to open files to infer a schema.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def compared(df: DataFrame, *means: str) -> DataFrame:
    """Types both engines hand over alike: text for dates, doubles for decimals, rounded means of means."""

    def column(f: T.StructField):
        c = F.col(f.name)
        if f.name in means:
            return F.round(c + 1e-7, 4)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double")
        return c

    return df.select(*[column(f).alias(f.name) for f in df.schema.fields])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``cents`` and the ``k`` of '{"k": 69}'.

    ``k`` comes out of a generator: a plain column would be put in place of its every use, the filters' as well, and the
    JSON parsed again for each."""
    k = F.get_json_object("props", "$.k").try_cast("int").alias("k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.floor(F.col("value") * 100 + 0.5).alias("cents"),
        F.inline(F.array(F.struct(k))),
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").withColumnRenamed("n_name", "state")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").withColumnRenamed("r_name", "region")


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events at their station. Joined one table at a time: each is small by its file size, so Spark broadcasts it,
    while the estimate for nation joined with region could outgrow the events'."""
    return (
        _events(spark, sf_dir)
        .join(_nations(spark, sf_dir), F.col("user_id") % 25 == F.col("n_nationkey"))
        .join(_regions(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-like hourly observations, one per event."""
    cents, k = F.col("cents"), F.col("k")
    rain = F.when(F.col("event_type") == "error", cents).otherwise(0) / 1024
    return _located(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("city"),
        "state",
        "region",
        (F.col("user_id") % 181 - 90).cast("double").alias("latitude"),
        (F.col("user_id") % 361 - 180).cast("double").alias("longitude"),
        F.when(F.col("user_id") % 2 == 0, "sensor").otherwise("station").alias("source"),
        F.when(k != 7, (cents % 5120) / 128).alias("temperature_2m"),
        F.when(k != 13, rain).alias("precipitation_mm"),
        k.cast("double").alias("relative_humidity_2m"),
        (cents % 97).cast("double").alias("wind_speed_kmh"),
        (cents % 900).cast("double").alias("shortwave_radiation"),
        (k / 64).alias("evapotranspiration"),
    )


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like records of 25 stations with repeats, missing keys, text numbers and values out of range."""
    cents, k, station = F.col("cents"), F.col("k"), F.col("n_nationkey")
    hour = F.date_format("ts", "yyyy-MM-dd'T'HH':00'")
    return _located(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.when(k == 3, F.lit(None)).when(k == 4, "not a time").otherwise(hour).alias("timestamp"),
        F.when(k == 5, "").otherwise(F.concat(F.lit("C"), station.cast("string"))).alias("city"),
        "state",
        "region",
        F.when(k == 6, 95.5).otherwise(station * 4 - 50).cast("double").alias("latitude"),
        (station * 7 - 90).cast("double").alias("longitude"),
        F.when(k == 9, "n/a").otherwise(((cents % 5120) / 128).cast("string")).alias("temperature_2m"),
        (k + 5).cast("double").alias("relative_humidity_2m"),
        F.when(k != 13, (cents % 64).cast("double")).alias("precipitation_mm"),
        F.when(k != 14, (cents % 97 - 2).cast("double")).alias("wind_speed_kmh"),
        F.lit("sensor").alias("source"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingestion_timestamp"),
        F.concat(F.lit("run-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("pipeline_execution_id"),
    )


def rule_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as the rules see them: numeric temperature."""
    raw = obs_raw(spark, sf_dir)
    return raw.withColumn("temperature_2m", F.col("temperature_2m").try_cast("double"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One three-hour payload per event; the temperature array is absent, short, long or fitting by turns."""
    k = F.col("k")
    base = (F.col("cents") % 5120) / 128
    hours = F.array(*[F.date_format(F.expr(f"ts + interval {h} hours"), "yyyy-MM-dd'T'HH:mm") for h in range(3)])

    def readings(n: int):
        return F.array(*[base + h for h in range(n)])

    temperature = F.when(k % 4 == 1, readings(2)).when(k % 4 == 2, readings(4)).when(k % 4 == 3, readings(3))
    absent = F.lit(None).cast("array<double>")
    arrays = {name: absent for name in HOURLY_ARRAYS}
    arrays["temperature_2m"] = temperature
    arrays["precipitation"] = F.array((F.col("cents") % 64).cast("double"))
    return _events(spark, sf_dir).select(
        F.concat(F.lit("C"), (F.col("user_id") % 25).cast("string")).alias("city"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("state"),
        F.when(F.col("event_type") != "view", F.lit(1.5)).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        F.struct(hours.alias("time"), *[array.alias(name) for name, array in arrays.items()]).alias("hourly"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("payload_file"),
        "k",
    )


def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads as JSON; some are cut off, some empty, some have text where a number is due."""
    k = F.col("k")
    text = F.to_json(F.struct("latitude", "longitude", "hourly"))
    value = (
        F.when(k == 3, F.substring(text, 1, 40))
        .when(k == 4, "  ")
        .when(k == 5, F.replace(text, F.lit('"longitude":2.5'), F.lit('"longitude":"east"')))
        .otherwise(text)
    )
    return payloads(spark, sf_dir).select("payload_file", "city", "state", value.alias("value"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations for the payloads."""
    return _nations(spark, sf_dir).select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("city"),
        "state",
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("region"),
        (F.col("n_nationkey") * 4 - 50).cast("double").alias("latitude"),
        (F.col("n_nationkey") * 7 - 90).cast("double").alias("longitude"),
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_gold(obs(spark, sf_dir), LIMITS)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_risk(gold(spark, sf_dir).withColumnRenamed("event_date", "full_date"))


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No hints: part and supplier grow with the data, so Spark broadcasts or shuffles them by their size.
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def _statistics(shipments: DataFrame, *columns) -> DataFrame:
    amounts = {
        "214": F.round("l_quantity").cast("double"),
        "215": F.round(F.col("l_extendedprice") * 100).cast("double"),
        "216": F.when(F.col("l_returnflag") != "R", F.round(F.col("l_discount") * 100)).cast("double"),
    }
    wide = shipments.select(*columns, *[amount.alias(code) for code, amount in amounts.items()])
    kept = [c for c in wide.columns if c not in amounts]
    return wide.unpivot(kept, list(amounts), "metric_code", "value")


def agri_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-like crop statistics, three metrics per shipment (metric 112 never occurs)."""
    return _statistics(
        _shipments(spark, sf_dir),
        F.year("l_shipdate").alias("year"),
        F.col("n_nationkey").cast("string").alias("territory_code"),
        F.col("n_name").alias("territory_name"),
        F.col("p_brand").alias("product_code"),
        F.col("p_brand").alias("product_name"),
    )


def agri_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like crop statistics: padded text, years that are none, blank names, repeated deliveries."""
    padded = F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit("  "))
    year = F.when(F.col("l_linenumber") == 7, "unknown").otherwise(F.year("l_shipdate").cast("string"))
    name = F.when(F.col("p_size") == 1, "  ").when(F.col("p_size") != 2, F.col("p_brand"))
    long = _statistics(
        _shipments(spark, sf_dir),
        year.alias("year"),
        padded.alias("territory_code"),
        F.col("n_name").alias("territory_name"),
        F.col("p_brand").alias("product_code"),
        name.alias("product_name"),
        F.lit("ibge_pam").alias("source"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ingestion_timestamp"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("pipeline_execution_id"),
    )
    return long.withColumns({"metric_name": F.lit("metric"), "unit": F.lit(" t ")})


def agri_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as the statistics office writes them."""
    size = F.col("p_size")
    text = (
        F.when(size % 5 == 0, "-")
        .when(size % 5 == 1, "...")
        .when(size % 5 == 3, F.concat(size.cast("string"), F.lit(",5")))
        .when(size % 5 == 4, "n/a")
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("value_text"))


def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agriculture_gold(agri_long(spark, sf_dir))


def sourced_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops from two offices: with one constant source, a join on it would turn into a cross join."""
    office = F.when(F.col("product_code") < "Brand#2", "ibge_pam").otherwise("survey")
    return crops(spark, sf_dir).withColumn("source", office)
