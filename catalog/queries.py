"""Every operator as a query over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrilake.functions.ids import number_rows, weather_record_id
from agrilake.functions.numbers import parse_statistic
from agrilake.functions.risk import temperature_band
from agrilake.operators import gates, gold, quality, reports, silver, star
from agrilake.operators.agriculture import agriculture_gold, agriculture_silver
from agrilake.plans.jobs import in_date_range, next_date
from agrilake.schemas import (
    DIM_CROP,
    DIM_DATE,
    DIM_LOCATION,
    DIM_SOURCE,
    FACT_AGRICULTURE,
    FACT_WEATHER,
)
from agrilake.sources.landed import parsed_payloads, weather_records
from agrilake.sources.reading import unite
from catalog import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LOADED_AT, LATER = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _on_readings(name: str, report: Callable[[DataFrame], DataFrame], *means: str) -> None:
    QUERIES[name] = lambda spark, sf: fx.compared(report(fx.readings(spark, sf)), *means)


# --- weather core -----------------------------------------------------------------------------------------


@query
def gold_daily(spark, sf):
    return fx.compared(gold.daily_weather(fx.obs(spark, sf)))


@query
def rolling_metrics(spark, sf):
    rolled = gold.with_rolling(gold.daily_weather(fx.obs(spark, sf)))
    kept = ["event_date", "city", "state", *[m.name for m in gold.ROLLING]]
    return fx.compared(rolled.select(*kept), "avg_temperature_7d", "avg_temperature_30d")


@query
def rolling_calendar(spark, sf):
    """Frames of calendar days, and where they hold fewer rows than the frames of rows do."""
    rolled = gold.with_calendar_rolling(gold.with_rolling(gold.daily_weather(fx.obs(spark, sf))))
    gap = F.col("precipitation_accumulated_30d") != F.col("precipitation_in_30_days")
    kept = rolled.select("event_date", "city", "state", *[m.name for m in gold.CALENDAR], gap.alias("differs_from_rows"))
    return fx.compared(kept, "avg_temperature_in_7_days", "avg_temperature_in_30_days")


@query
def risk_flags(spark, sf):
    flags = ["thermal_amplitude", "drought_risk", "heat_risk", "heavy_rain_risk", "year", "month"]
    return fx.compared(fx.gold(spark, sf).select("event_date", "city", "state", *flags))


_on_readings("risk_level", lambda r: r.select("full_date", "city", "state", "risk_events", "risk_level"))


@query
def typed_cast(spark, sf):
    typed = silver.typed_weather(fx.obs_raw(spark, sf))
    kept = ["event_timestamp", "event_date", "year", "month", "latitude", "temperature_2m", "wind_speed_kmh"]
    return fx.compared(typed.select("seq", *kept))


@query
def record_id(spark, sf):
    return fx.obs_raw(spark, sf).select("seq", weather_record_id().alias("weather_record_id"))


@query
def silver_filter(spark, sf):
    valid = silver.typed_weather(fx.obs_raw(spark, sf)).where(silver.is_valid_weather())
    return valid.select("seq", "city", "relative_humidity_2m", "precipitation_mm", "wind_speed_kmh")


@query
def silver_dedup(spark, sf):
    kept = ["weather_record_id", "seq", "pipeline_execution_id", "event_timestamp", "temperature_2m"]
    return fx.compared(silver.weather_silver(fx.obs_raw(spark, sf)).select(*kept))


@query
def obs_enrich(spark, sf):
    return fx.compared(fx.obs(spark, sf).select("seq", "event_date", "city", "state", "region", "temperature_2m"))


_on_readings(
    "obs_filter",
    lambda r: reports.filter_readings(
        r, dt.date(2024, 1, 8), dt.date(2024, 1, 21), ["NATION_3", "NATION_8", "NATION_17"], None, ["Atencao", "Critico"]
    ).select("full_date", "city", "state", "risk_level", "max_temperature"),
)
_on_readings("filter_options", lambda r: reports.filter_options(r, ["NATION_3", "NATION_8"]))


@query
def incremental_slice(spark, sf):
    start = next_date("2024-01-20", dt.date(2024, 1, 1))
    rows = fx.obs(spark, sf).where(in_date_range(F.col("event_date"), start, dt.date(2024, 1, 25)))
    return fx.compared(rows.select("seq", "event_date", "city"))


@query
def latest_points(spark, sf):
    latest = reports.at_latest(fx.readings(spark, sf), "full_date")
    kept = ["full_date", "city", "state", "latitude", "longitude", "total_precipitation", "risk_level"]
    return fx.compared(latest.select(*kept))


@query
def array_normalize(spark, sf):
    records = weather_records(fx.payloads(spark, sf), fx.stations(spark, sf))
    kept = ["timestamp", "city", "region", "latitude", "longitude", "temperature_2m", "precipitation_mm"]
    return records.select("record_order", *kept)


@query
def payload_quarantine(spark, sf):
    parsed = parsed_payloads(fx.payload_texts(spark, sf))
    readable = F.col("unreadable").isNull()
    return parsed.select(
        "payload_file",
        "city",
        "latitude",
        "longitude",
        F.when(~readable, "unreadable_payload").alias("reason"),
        F.when(readable, F.size("hourly.time")).alias("hours"),
        F.get("hourly.temperature_2m", F.lit(0)).alias("first_temperature"),
    )


@query
def union_all(spark, sf):
    rows = fx.obs(spark, sf)
    wet = rows.where(F.col("precipitation_mm") > 0).select("seq", "city", "precipitation_mm")
    dry = rows.where(F.coalesce("precipitation_mm", F.lit(0.0)) <= 0).select("city", "seq", "temperature_2m")
    return unite(wet, dry)


# --- quality ----------------------------------------------------------------------------------------------


@query
def rule_reasons(spark, sf):
    return fx.rule_records(spark, sf).select("seq", quality.rule_reason().alias("reason"))


@query
def quality_split(spark, sf):
    return quality.judge(fx.rule_records(spark, sf), "seq").select("seq", "reason", "accepted")


@query
def quarantine_counts(spark, sf):
    records = fx.rule_records(spark, sf)
    split = quality.split_judged(quality.judge(records, "seq"), records.columns, "run-1")
    return split.quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).orderBy("reason")


@query
def dq_report(spark, sf):
    return gates.gate_report(silver.typed_weather(fx.obs_raw(spark, sf)), gates.silver_weather_gate())


@query
def dq_report_gold(spark, sf):
    return gates.gate_report(fx.gold(spark, sf), gates.gold_weather_gate())


@query
def dq_report_agri(spark, sf):
    return gates.gate_report(fx.crops(spark, sf), gates.gold_agriculture_gate())


@query
def dq_unique(spark, sf):
    ids = fx.obs_raw(spark, sf).select(weather_record_id().alias("weather_record_id"))
    return gates.repeated_values(ids, ["weather_record_id"])


# --- crop statistics --------------------------------------------------------------------------------------


@query
def number_parse(spark, sf):
    return fx.agri_text(spark, sf).select("p_partkey", parse_statistic(F.col("value_text")).alias("value"))


@query
def agri_silver(spark, sf):
    kept = ["year", "territory_code", "metric_code", "product_code", "product_name", "value", "unit", "data_source"]
    return agriculture_silver(fx.agri_raw(spark, sf)).select(*kept, "pipeline_execution_id")


@query
def agri_gold(spark, sf):
    return fx.compared(agriculture_gold(fx.agri_long(spark, sf)), "calculated_yield_t_ha", "reported_yield_t_ha")


@query
def prod_by_crop(spark, sf):
    return reports.production_by_crop(fx.crops(spark, sf), all_years=True)


@query
def prod_by_crop_latest(spark, sf):
    return reports.production_by_crop(fx.crops(spark, sf))


@query
def prod_by_state(spark, sf):
    return reports.production_by_state(fx.crops(spark, sf), all_years=True)


@query
def prod_by_state_latest(spark, sf):
    return reports.production_by_state(fx.crops(spark, sf))


@query
def agri_kpi(spark, sf):
    return reports.crop_figures(fx.crops(spark, sf))


@query
def crop_table(spark, sf):
    same_names = {name: name for name in ("year", "territory_name", "product_name", "produced_quantity", "harvested_area")}
    return reports.crop_table(fx.crops(spark, sf), same_names)


# --- star schema ------------------------------------------------------------------------------------------


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def _staging_of(rows):
    """Dimension columns of observations in warehouse types, without computing the gold rows first."""
    return rows.select(
        "event_date",
        "city",
        "state",
        "region",
        F.col("latitude").cast("decimal(9,6)").alias("latitude"),
        F.col("longitude").cast("decimal(9,6)").alias("longitude"),
        "source",
    )


def _sources(spark, staging):
    seed = spark.createDataFrame([(1, *star.SEED_SOURCE)], DIM_SOURCE)
    return star.merge_sources(seed, staging, star.WEATHER_SOURCE_TYPE)


def _dimensions(spark, sf):
    """Dates, locations and sources of a first load."""
    staging = _staging_of(fx.obs(spark, sf))
    locations = number_rows(star.location_rows(staging), star.LOCATION_KEY, "location_id")
    return star.date_rows(staging), locations, _sources(spark, staging)


def _facts(spark, gold_rows, locations, sources):
    # Means of means differ between engines in the last bit; settle them before the warehouse cuts to 2 digits.
    means = {name: F.round(F.col(name) + 1e-7, 4) for name in ("avg_temperature_7d", "avg_temperature_30d")}
    staging = star.weather_staging(gold_rows.withColumns(means))
    return star.weather_fact_rows(staging, locations, sources, F.lit(LOADED_AT).cast("timestamp"))


@query
def dim_date(spark, sf):
    """Two overlapping loads; the second adds only the days the first did not bring."""
    rows = fx.obs(spark, sf)
    early = rows.where(F.col("event_date") <= F.lit(fx.FIRST_BATCH_END))
    late = rows.where(F.col("event_date") >= F.lit(fx.SECOND_BATCH_START))
    first = star.merge_dates(_empty(spark, DIM_DATE), _staging_of(early))
    return fx.compared(star.merge_dates(first, _staging_of(late)))


@query
def dim_location(spark, sf):
    """Two loads: the second brings new cities and moves every city it knows to a new region name."""
    rows = fx.obs(spark, sf)
    early = rows.where(F.col("event_date") <= F.lit(dt.date(2024, 1, 2)))
    late = rows.where(F.col("event_date") >= F.lit(dt.date(2024, 1, 2))).withColumn(
        "region", F.concat(F.col("region"), F.lit(" II"))
    )
    first = star.merge_locations(_empty(spark, DIM_LOCATION), _staging_of(early))
    return fx.compared(star.merge_locations(first, _staging_of(late)))


@query
def dim_source(spark, sf):
    known = _sources(spark, _staging_of(fx.obs(spark, sf)))
    staging = star.agriculture_staging(fx.sourced_crops(spark, sf))
    return star.merge_sources(known, staging, star.AGRICULTURE_SOURCE_TYPE)


@query
def dim_crop(spark, sf):
    """Two loads: the second brings new crops and gives every crop it knows another name."""
    staging = star.agriculture_staging(fx.crops(spark, sf))
    early = staging.where(f"year <= {fx.SHARED_YEAR} and product_code < 'Brand#4'")
    late = staging.where(f"year >= {fx.SHARED_YEAR}").withColumn("product_name", F.concat("product_name", F.lit(" II")))
    return star.merge_crops(star.merge_crops(_empty(spark, DIM_CROP), early), late)


@query
def fact_weather(spark, sf):
    _, locations, sources = _dimensions(spark, sf)
    rows = _facts(spark, fx.gold(spark, sf), locations, sources)
    return fx.compared(star.merge_weather_facts(_empty(spark, FACT_WEATHER), rows))


def _stamped(rows, loaded_at):
    return rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp"))


@query
def fact_agri(spark, sf):
    """Two loads that share a year; the second reports a ton more and no value, and arrives later."""
    staging = star.agriculture_staging(fx.sourced_crops(spark, sf))
    crops = star.merge_crops(_empty(spark, DIM_CROP), staging)
    sources = star.merge_sources(_empty(spark, DIM_SOURCE), staging, star.AGRICULTURE_SOURCE_TYPE)
    rows = star.agriculture_fact_rows(staging, crops, sources, F.lit(LOADED_AT).cast("timestamp"))
    early = rows.where(F.col("year") <= fx.SHARED_YEAR)
    changed = {
        "produced_quantity": (F.col("produced_quantity") + 1).cast("decimal(18,2)"),
        "production_value": F.lit(None).cast("decimal(18,2)"),
    }
    late = _stamped(rows.where(F.col("year") >= fx.SHARED_YEAR).withColumns(changed), LATER)
    first = star.merge_agriculture_facts(_empty(spark, FACT_AGRICULTURE), early)
    return fx.compared(star.merge_agriculture_facts(first, late))


@query
def fact_upsert(spark, sf):
    """Two overlapping loads; the second is one degree warmer, arrives later and lacks humidity. All measures."""
    _, locations, sources = _dimensions(spark, sf)
    rows = _facts(spark, fx.gold(spark, sf), locations, sources)
    early = rows.where(F.col("date_id") <= int(f"{fx.FIRST_BATCH_END:%Y%m%d}"))
    changed = {
        "avg_temperature": (F.col("avg_temperature") + 1).cast("decimal(6,2)"),
        "avg_humidity": F.lit(None).cast("decimal(6,2)"),
    }
    late = rows.where(F.col("date_id") >= int(f"{fx.SECOND_BATCH_START:%Y%m%d}")).withColumns(changed)
    first = star.merge_weather_facts(_empty(spark, FACT_WEATHER), early)
    return fx.compared(star.merge_weather_facts(first, _stamped(late, LATER)))


@query
def fk_check(spark, sf):
    """Facts against dimensions from which one region and the days after the 25th were lost."""
    dates, locations, sources = _dimensions(spark, sf)
    facts = _facts(spark, fx.gold(spark, sf), locations, sources)
    references = {
        "date_id": dates.where("day <= 25"),
        "location_id": locations.where("region <> 'ASIA'"),
        "source_id": sources,
    }
    return star.foreign_key_report(facts, references)


@query
def star_read(spark, sf):
    dates, locations, sources = _dimensions(spark, sf)
    facts = _facts(spark, fx.gold(spark, sf), locations, sources)
    return fx.compared(star.in_day_order(star.read_star(facts, dates, locations)))


# --- reports ----------------------------------------------------------------------------------------------

_SNAPSHOT_MEANS = ("avg_temperature", "previous_avg_temperature", "avg_humidity", "previous_avg_humidity")

_on_readings("rain_by_state", reports.rain_by_state)
_on_readings("monthly_temp", reports.monthly_temperature)
_on_readings("hottest_cities", reports.hottest_cities)
_on_readings("wettest_cities", reports.wettest_cities)
_on_readings("dry_days", reports.dry_days)
_on_readings("snapshot_kpi", reports.latest_snapshot, *_SNAPSHOT_MEANS)
_on_readings("risk_summary", reports.risk_summary)
_on_readings("risk_top10", reports.risk_top)
_on_readings("insights", reports.insights)
_on_readings("daily_state", reports.daily_by_state, "avg_temperature")
_on_readings("risk_share", reports.risk_share)
_on_readings("water_balance", reports.water_balance)
_on_readings("city_rain", reports.city_rain)
_on_readings(
    "rolling_3d",
    lambda r: reports.rolling_3d(r).select("full_date", "city", "state", "temperature_rolling_3d"),
    "temperature_rolling_3d",
)
_on_readings("export_table", lambda r: reports.export_table(r, {name: name for name in reports.READING_HEADINGS}))


@query
def latest_temp_rank(spark, sf):
    ranking = reports.temperature_ranking(fx.readings(spark, sf))
    return fx.compared(ranking.drop("band"), "avg_temperature")


@query
def temp_band(spark, sf):
    readings = fx.readings(spark, sf)
    banded = readings.withColumn("band", temperature_band(F.col("avg_temperature")))
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).orderBy("band")


@query
def trend_top_cities(spark, sf):
    trend = reports.trend_top_cities(fx.readings(spark, sf))
    kept = ["full_date", "city", "state", "avg_temperature", "temperature_rolling_3d"]
    return fx.compared(trend.select(*kept), "temperature_rolling_3d")


@query
def risk_by_state(spark, sf):
    return reports.risk_by_state(fx.readings(spark, sf))


@query
def dataset_summary(spark, sf):
    return fx.compared(reports.dataset_summary(fx.readings(spark, sf), fx.crops(spark, sf)))


def _exposed(spark, sf):
    climate = reports.climate_by_state(fx.readings(spark, sf))
    return reports.crops_with_climate(fx.crops(spark, sf), climate, fx.STATE_BY_TERRITORY)


@query
def agri_climate(spark, sf):
    kept = ["territory_code", "product_code", "state", "produced_quantity", "bubble_size"]
    climate = ["eventos_de_risco", "temperatura_media", "chuva_total"]
    return fx.compared(_exposed(spark, sf).select(*kept, *climate), "temperatura_media")


@query
def exposure_top(spark, sf):
    kept = ["territory_name", "product_name", "produced_quantity", "eventos_de_risco", "bubble_size"]
    return reports.exposure_top(_exposed(spark, sf)).select(*kept)


@query
def agro_score(spark, sf):
    scored = reports.climate_crop_score(_exposed(spark, sf))
    weights = ["production_weight", "temperature_weight", "risk_weight", "temperatura_media"]
    kept = ["state", "territory_name", "produced_quantity", "eventos_de_risco", "chuva_total", "score"]
    return fx.compared(scored.select(*kept, *weights), *weights)

