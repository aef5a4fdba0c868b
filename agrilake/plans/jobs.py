"""The batch jobs: ingestion, bronze to silver to gold with blocking gates, and the whole run."""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agrilake.config import AGRICULTURE_SOURCE, WEATHER_SOURCE, LakeConfig
from agrilake.operators import gates
from agrilake.operators.agriculture import agriculture_gold, agriculture_silver
from agrilake.operators.quality import judge, split_judged
from agrilake.plans.refinement import refine_weather
from agrilake.plans.warehouse_load import load_gold
from agrilake.schemas import (
    BRONZE_AGRICULTURE,
    BRONZE_WEATHER,
    SILVER_AGRICULTURE,
    WEATHER_RECORD,
)
from agrilake.sources import lake
from agrilake.sources.landed import (
    FILE,
    landed_files,
    read_statistics_payloads,
    read_weather_payloads,
    statistics_records,
    statistics_rows,
    weather_records,
)
from agrilake.sources.metadata import MetadataStore
from agrilake.sources.reading import read_files, read_layer
from agrilake.sources.reference import read_locations, read_products

LOG = logging.getLogger(__name__)
WEATHER_JOB, AGRICULTURE_JOB = "weather_ingestion", "agriculture_ingestion"


def new_execution_id() -> str:
    return str(uuid.uuid4())


def next_date(last_ingested: str | None, initial: dt.date) -> dt.date:
    """The day after the last ingested one, else the configured first day."""
    return dt.date.fromisoformat(last_ingested) + dt.timedelta(days=1) if last_ingested else initial


def in_date_range(day: Column, start: dt.date, end: dt.date) -> Column:
    """Inside the range; a day that cannot be read stays in, so that the rules can reject it."""
    return day.isNull() | day.between(F.lit(start), F.lit(end))


def _stage(df: DataFrame, config: LakeConfig, name: str) -> DataFrame:
    """``df`` written to the staging folder and read back, so that what follows doesn't go to the landing again."""
    path = f"{config.staging_root(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unreadable(payloads: DataFrame, execution_id: str) -> DataFrame:
    """Quarantine rows of payloads that can't be read, with their whole text."""
    return payloads.where(F.col("unreadable").isNotNull()).select(
        *FILE,
        F.col("unreadable").alias("payload"),
        F.lit("unreadable_payload").alias("reason"),
        F.array(F.lit("unreadable_payload")).alias("reasons"),
        F.current_timestamp().alias("validation_timestamp"),
        F.lit(execution_id).alias("pipeline_execution_id"),
    )


def ingest_weather(
    spark: SparkSession,
    config: LakeConfig,
    landing_path: str,
    execution_id: str,
    today: dt.date | None = None,
    locations: DataFrame | None = None,
) -> dict[str, Any]:
    """Landed payloads not ingested yet to bronze and quarantine, late days too.

    The listing of the landing tells new files, by path, time and size; no other file's content is read. A file is done
    with once its rows are in. One with days after today is read again by later runs, which take the later days only;
    one from a place that isn't known waits. A payload that can't be read goes to quarantine, and doesn't stop the
    others. Days before the configured first one are out of scope. ``records_extracted`` is the sum of the valid
    and the rejected, where an unreadable payload counts as one record.
    """
    started = time.perf_counter()
    started_at = dt.datetime.now(dt.timezone.utc).isoformat()
    store = MetadataStore(spark, config.metadata_root)
    last = store.load(WEATHER_JOB, WEATHER_SOURCE).last_ingested_date
    start, end = config.initial_ingestion_date, today or dt.date.today()
    places = read_locations(spark) if locations is None else locations
    files = _stage(store.new_files(WEATHER_JOB, landed_files(spark, landing_path)), config, f"weather_files_{execution_id}")
    oldest = files.agg(F.min("payload_modified")).first()[0]
    if start > end or oldest is None:
        LOG.info("nothing to ingest up to %s", end)
        return {"records_extracted": 0, "last_ingested_date": last}
    here = places.select("city", "state").distinct().withColumn("known", F.lit(True))
    payloads = read_weather_payloads(spark, landing_path, oldest).join(files, FILE).join(here, ["city", "state"], "left")
    payloads = _stage(payloads, config, f"weather_payloads_{execution_id}")

    day = F.to_date(F.col("timestamp").try_cast("timestamp_ntz"))
    # what an earlier run took from a file stays taken; a day that can't be read was among it
    fresh = F.col("through").isNull() | F.coalesce(day > F.col("through"), F.lit(False))
    records = weather_records(payloads, places, also=["through"]).where(fresh & in_date_range(day, start, end)).drop("through")

    # Judged once into a shared staging table: both outputs then read only their own half of it.
    staged = f"{config.staging_root(spark)}/weather_{execution_id}"
    counts = Observation()
    judged = judge(records, "record_order", config.thresholds).observe(
        counts, F.count(F.lit(1)).alias("extracted"), F.count_if("accepted").alias("valid")
    )
    judged.write.mode("overwrite").partitionBy("accepted").parquet(staged)
    judged_rows, valid = counts.get["extracted"], counts.get["valid"]
    if judged_rows:
        split = split_judged(spark.read.schema(judged.schema).parquet(staged), WEATHER_RECORD.fieldNames(), execution_id)
        accepted = lake.stamp_weather(split.accepted, execution_id)
        lake.write_run(accepted, config.layer("bronze", "weather"), end, execution_id)
        if valid < judged_rows:
            lake.write_quarantine(split.quarantined, config.layer("quarantine", "weather"), execution_id)

    last_day = F.array_max(F.transform("hourly.time", lambda hour: F.to_date(hour.try_cast("timestamp_ntz"))))
    is_known = F.coalesce("known", F.lit(False))
    figures = payloads.agg(
        F.count_if(F.col("unreadable").isNotNull()).alias("unreadable"),
        F.count_if(F.col("unreadable").isNull() & ~is_known).alias("unplaced"),
    ).first()
    if figures["unreadable"]:
        lake.write_quarantine(_unreadable(payloads, execution_id), config.layer("quarantine", "weather_payloads"), execution_id)
    if figures["unplaced"]:
        LOG.warning("%d payloads are from places that aren't known and wait", figures["unplaced"])
    ended = F.coalesce(last_day <= F.lit(end), F.lit(True))
    notes = payloads.select(
        *FILE,
        (F.col("unreadable").isNotNull() | is_known & ended).alias("done"),
        F.when(is_known, F.lit(end)).alias("through"),
    )
    store.append_files(WEATHER_JOB, notes)

    seconds = time.perf_counter() - started
    extracted = judged_rows + figures["unreadable"]
    rejected = extracted - valid
    if extracted:  # the mark stays where it is while nothing has landed
        store.record_success(WEATHER_JOB, WEATHER_SOURCE, end, valid, seconds)
    store.append_dataset_metric(
        execution_id, "weather", "bronze", valid, records_extracted=extracted, records_rejected=rejected
    )
    store.append_run(
        execution_id,
        started_at=started_at,
        finished_at=dt.datetime.now(dt.timezone.utc).isoformat(),
        duration_seconds=seconds,
        records_extracted=extracted,
        records_rejected=rejected,
        status="success",
    )
    return {
        "records_extracted": extracted,
        "records_valid": valid,
        "records_rejected": rejected,
        "last_ingested_date": end.isoformat() if extracted else last,
    }


def ingest_agriculture(
    spark: SparkSession,
    config: LakeConfig,
    landing_path: str,
    execution_id: str,
    today: dt.date | None = None,
    products: DataFrame | None = None,
) -> dict[str, Any]:
    """Landed crop statistics of the known products to bronze, from new files only; unreadable ones to quarantine.

    Files are noted with the rows of products unknown then; deliver them again once a product is added.
    """
    started = time.perf_counter()
    day = today or dt.date.today()
    store = MetadataStore(spark, config.metadata_root)
    target = config.layer("bronze", "agriculture")
    files = _stage(store.new_files(AGRICULTURE_JOB, landed_files(spark, landing_path)), config, f"crop_files_{execution_id}")
    oldest = files.agg(F.min("payload_modified")).first()[0]
    if oldest is None:
        LOG.info("no new crop statistics")
        return {"records_extracted": 0, "output_path": target}
    payloads = read_statistics_payloads(spark, landing_path, oldest).join(files, FILE)
    payloads = _stage(payloads, config, f"crop_payloads_{execution_id}")
    known = (read_products(spark) if products is None else products).select("product_code").distinct()
    records = statistics_records(statistics_rows(payloads)).join(known, "product_code", "left_semi")
    counts = Observation()
    stamped = lake.stamp_agriculture(records, execution_id).select(*BRONZE_AGRICULTURE.fieldNames())
    lake.write_run(stamped.observe(counts, F.count(F.lit(1)).alias("rows")), target, day, execution_id)
    rows = counts.get["rows"]
    broken = payloads.where(F.col("unreadable").isNotNull()).count()
    if broken:
        LOG.warning("%d crop payloads can't be read and are in quarantine", broken)
        lake.write_quarantine(_unreadable(payloads, execution_id), config.layer("quarantine", "agriculture_payloads"), execution_id)
    store.append_files(AGRICULTURE_JOB, payloads.select(*FILE, F.lit(True).alias("done"), F.lit(day).alias("through")))
    store.record_success(AGRICULTURE_JOB, AGRICULTURE_SOURCE, day, rows, time.perf_counter() - started)
    return {"records_extracted": rows, "output_path": target, **({"payloads_rejected": broken} if broken else {})}


def refine_agriculture(spark: SparkSession, config: LakeConfig) -> dict[str, int]:
    silver, gold = config.layer("silver", "agriculture"), config.layer("gold", "agriculture_summary")
    bronze = read_files(spark, config.layer("bronze", "agriculture"), BRONZE_AGRICULTURE)
    silver_rows = lake.write_whole(agriculture_silver(bronze), silver)
    gold_rows = lake.write_whole(agriculture_gold(read_layer(spark, silver, SILVER_AGRICULTURE)), gold)
    gates.check_path(spark, gold, gates.gold_agriculture_gate())
    return {"silver": silver_rows, "gold": gold_rows}


def run_all(
    spark: SparkSession,
    config: LakeConfig,
    weather_landing: str,
    agriculture_landing: str,
    today: dt.date | None = None,
    locations: DataFrame | None = None,
    products: DataFrame | None = None,
) -> dict[str, Any]:
    """Everything in order. Strict runs fail on any error; lenient ones go on without crop statistics."""
    execution_id = new_execution_id()
    store = MetadataStore(spark, config.metadata_root)
    result: dict[str, Any] = {"execution_id": execution_id}
    result["weather_ingestion"] = ingest_weather(spark, config, weather_landing, execution_id, today, locations)
    try:
        result["agriculture_ingestion"] = ingest_agriculture(
            spark, config, agriculture_landing, execution_id, today, products
        )
        result["agriculture"] = refine_agriculture(spark, config)
        for layer, rows in result["agriculture"].items():
            store.append_dataset_metric(execution_id, "agriculture", layer, rows)
    except Exception as failure:
        if config.strict:
            raise
        LOG.warning("crop statistics skipped: %s", failure)
    result["weather"] = refine_weather(spark, config)
    for layer, rows in result["weather"].items():
        store.append_dataset_metric(execution_id, "weather", layer, rows)
    # Crop statistics that failed on the way, at their gate for instance, stay out of the warehouse.
    result["rows_loaded"] = load_gold(spark, config, with_crops="agriculture" in result)
    return result
