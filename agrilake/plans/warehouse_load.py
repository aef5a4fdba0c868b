"""Gold to star schema in one all-or-nothing load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agrilake.config import LakeConfig
from agrilake.errors import LakeError, WarehouseLoadError
from agrilake.operators import star
from agrilake.operators.upsert import require_unique
from agrilake.schemas import GOLD_AGRICULTURE, GOLD_WEATHER
from agrilake.sources.metadata import MetadataStore
from agrilake.sources.reading import as_written, in_months, listed, read_layer, read_layer_or_none
from agrilake.sources.warehouse import Snapshot, Warehouse

STEP = "load_weather"


def _seeded(sources: DataFrame, spark: SparkSession) -> DataFrame:
    """The source dimension always knows the weather source."""
    seed = spark.createDataFrame([star.SEED_SOURCE], "source string, kind string").select("source")
    return star.merge_sources(sources, seed, star.WEATHER_SOURCE_TYPE)


def _staged(spark: SparkSession, root: str, name: str, staging: DataFrame) -> tuple[DataFrame, int]:
    """``staging`` written once to the shared folder, and its rows: gold is read, typed and checked a single time."""
    counts = Observation()
    path = f"{LakeConfig(root).staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    staging.observe(counts, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(staging.schema).parquet(path), counts.get["rows"]


def _merge_fact(warehouse: Warehouse, base: Snapshot, table: str, staging: DataFrame, rows: DataFrame, merge) -> dict[str, str]:
    """Rewrite the periods the batch touches."""
    touched = warehouse.periods_of(table, staging)
    merged = merge(warehouse.read(table, base, touched), rows)
    return warehouse.stage(table, merged, base.version + 1, touched)


def load_warehouse(
    spark: SparkSession, root: str, weather: DataFrame, agriculture: DataFrame | None = None
) -> int:
    """Upsert gold rows into the star tables below ``root``. Returns weather rows plus agriculture rows.

    Gold is read once, into a staging table. What the batch must fulfil is part of the plans that write (``refuse``
    and its users): a row that breaks a rule ends the load before anything becomes current.
    """
    warehouse = Warehouse(spark, root)
    weather_fact, crop_fact = "fact_weather_daily", "fact_agriculture_production"
    try:
        base = warehouse.snapshot()
        version = base.version + 1
        loaded_at = F.current_timestamp()
        checked = star.refuse_incomplete_locations(star.weather_staging(weather))
        staging, loaded = _staged(spark, root, weather_fact, checked)

        staged: dict[str, dict[str, str]] = {}
        staged["dim_date"] = warehouse.stage(
            "dim_date", star.merge_dates(warehouse.read("dim_date", base), staging), version
        )
        staged["dim_location"] = warehouse.stage(
            "dim_location", star.merge_locations(warehouse.read("dim_location", base), staging), version
        )
        sources = _seeded(warehouse.read("dim_source", base), spark)
        sources = star.merge_sources(sources, staging, star.WEATHER_SOURCE_TYPE)
        crop_staging = None
        if agriculture is not None:
            checked = star.refuse_incomplete_crops(star.agriculture_staging(agriculture))
            crop_staging, crop_rows = _staged(spark, root, crop_fact, checked)
            loaded += crop_rows
            sources = star.merge_sources(sources, crop_staging, star.AGRICULTURE_SOURCE_TYPE)
            staged["dim_crop"] = warehouse.stage(
                "dim_crop", star.merge_crops(warehouse.read("dim_crop", base), crop_staging), version
            )
        staged["dim_source"] = warehouse.stage("dim_source", sources, version)

        # Facts look their keys up in the dimensions as written, whose file sizes the planner can see.
        dims = Snapshot(version, {**base.entries, **staged})
        sources = warehouse.read("dim_source", dims)
        rows = star.weather_fact_rows(staging, warehouse.read("dim_location", dims), sources, loaded_at)
        staged[weather_fact] = _merge_fact(warehouse, base, weather_fact, staging, rows, star.merge_weather_facts)
        if crop_staging is not None:
            rows = star.agriculture_fact_rows(crop_staging, warehouse.read("dim_crop", dims), sources, loaded_at)
            staged[crop_fact] = _merge_fact(
                warehouse, base, crop_fact, crop_staging, rows, star.merge_agriculture_facts
            )
            # hashed ids of one year can only meet in the year's own rows, all of which were just written
            written = warehouse.read(crop_fact, Snapshot(version, staged))
            require_unique(written, ["agriculture_fact_id"], crop_fact)
        warehouse.commit(base, staged)
        return loaded
    except LakeError:
        raise
    except Exception as failure:
        raise WarehouseLoadError(f"warehouse load failed: {failure}") from failure


def load_gold(spark: SparkSession, config: LakeConfig, with_crops: bool = True) -> int:
    """Load the months of weather gold written since they were last loaded, and the crop statistics.

    Crops are skipped while there are none or when not wanted. A warehouse without weather takes every month.
    """
    store = MetadataStore(spark, config.metadata_root)
    gold = config.layer("gold", "weather_daily")
    weather = read_layer(spark, gold, GOLD_WEATHER)
    files = listed(spark, gold)
    months = []
    if files is not None:
        written = as_written(files, F.col("year") * 100 + F.col("month"))
        if "fact_weather_daily" in Warehouse(spark, config.warehouse_root).snapshot().entries:
            months, _ = store.pending(STEP, written)
            weather = weather.where(in_months([int(month) for month, _ in months]))
        else:
            months = [tuple(r) for r in written.collect()]  # one row per month
    crops = None
    if with_crops:
        crops = read_layer_or_none(spark, config.layer("gold", "agriculture_summary"), GOLD_AGRICULTURE)
    loaded = load_warehouse(spark, config.warehouse_root, weather, crops)
    if months:
        store.note(STEP, months, "done")
    return loaded


def read_readings(spark: SparkSession, config: LakeConfig) -> tuple[DataFrame, str]:
    """Daily readings for reports and where they came from: the warehouse, else the gold layer."""
    warehouse = Warehouse(spark, config.warehouse_root)
    snapshot = warehouse.snapshot()
    if "fact_weather_daily" in snapshot.entries:
        tables = [warehouse.read(name, snapshot) for name in ("fact_weather_daily", "dim_date", "dim_location")]
        return star.read_star(*tables), "warehouse"
    gold = read_layer(spark, config.layer("gold", "weather_daily"), GOLD_WEATHER)
    return gold.withColumnRenamed("event_date", "full_date"), "gold"


def read_crops(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """Crop statistics for reports, which order what they hand out; empty while there are none."""
    return read_layer(spark, config.layer("gold", "agriculture_summary"), GOLD_AGRICULTURE)


def in_display_order(crops: DataFrame) -> DataFrame:
    """The crop statistics as they are handed out."""
    return crops.orderBy(*[F.col(c).asc_nulls_last() for c in ("year", "territory_name", "product_name")])
