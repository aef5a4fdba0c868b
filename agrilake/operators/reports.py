"""Reports over daily readings and crop statistics.

``readings`` are gold rows (or the joined star) with ``full_date``, risk columns and, after ``with_risk``,
``risk_events`` and ``risk_level``. Every top-k has a tie-break, so equal input gives equal output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrilake.functions import labels, risk
from agrilake.operators.rolling import Rolling, rolling_rows
from agrilake.schemas import RISK_COLUMNS

CITY = ["city", "state"]

# Column headings of the exported tables.
READING_HEADINGS = {
    "full_date": "Data",
    "city": "Cidade",
    "state": "UF",
    "region": "Regiao",
    "avg_temperature": "Temp. media",
    "max_temperature": "Temp. maxima",
    "total_precipitation": "Chuva total",
    "avg_humidity": "Umidade media",
    "days_without_rain": "Dias sem chuva",
    "drought_risk": "Risco seca",
    "heat_risk": "Risco calor",
    "heavy_rain_risk": "Risco chuva forte",
}
RISK_SUMMARY_HEADINGS = {
    "city": "Cidade",
    "state": "UF",
    "dias_monitorados": "Dias monitorados",
    "eventos_de_risco": "Eventos de risco",
    "maior_sequencia_seca": "Maior sequencia seca",
    "chuva_7d_max": "Max. chuva 7d",
    "temperatura_maxima": "Temp. maxima",
}
CROP_HEADINGS = {
    "year": "Ano",
    "territory_name": "UF",
    "product_name": "Cultura",
    "produced_quantity": "Producao",
    "harvested_area": "Area colhida",
    "reported_yield_t_ha": "Produtividade informada",
    "calculated_yield_t_ha": "Produtividade calculada",
    "production_value": "Valor da producao",
}


def with_headings(df: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(name).alias(heading) for name, heading in headings.items()])


def _top(df: DataFrame, by: str, ties: Sequence[str], k: int | None) -> DataFrame:
    ordered = df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return ordered if k is None else ordered.limit(k)


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the largest value of ``column``. The maximum is a scalar subquery, so the filter can reach the scan."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


# --- readings ---------------------------------------------------------------------------------------------


def with_risk(readings: DataFrame) -> DataFrame:
    """Risk events and level; a risk column the data does not have counts as normal."""
    absent = {name: F.lit(risk.NORMAL) for name in RISK_COLUMNS if name not in readings.columns}
    complete = readings.withColumns(absent) if absent else readings
    counted = complete.withColumn("risk_events", risk.risk_events())
    return counted.withColumn("risk_level", risk.risk_level(F.col("risk_events")))


def filter_readings(
    readings: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    states: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
    levels: Sequence[str] | None = None,
    day: str = "full_date",
) -> DataFrame:
    """Interactive selection; None selects everything. Date bounds also prune year and month partitions when present."""
    picked = readings
    if start is not None:
        picked = picked.where(F.col(day) >= F.lit(start))
    if end is not None:
        picked = picked.where(F.col(day) <= F.lit(end))
    if "year" in readings.columns:
        if start is not None:
            picked = picked.where(F.col("year") >= start.year)
        if end is not None:
            picked = picked.where(F.col("year") <= end.year)
    if {"year", "month"} <= set(readings.columns):
        month = F.col("year") * 100 + F.col("month")
        if start is not None:
            picked = picked.where(month >= start.year * 100 + start.month)
        if end is not None:
            picked = picked.where(month <= end.year * 100 + end.month)
    for name, values in (("state", states), ("city", cities), ("risk_level", levels)):
        if values is not None:
            picked = picked.where(F.col(name).isin(*values))
    return picked


def filter_options(readings: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """(kind, option) rows: states, the cities inside the chosen states, first and last day."""
    inside = filter_readings(readings, states=states)

    def distinct(df: DataFrame, kind: str, name: str) -> DataFrame:
        values = df.select(F.col(name).cast("string").alias("option")).dropna().distinct()
        return values.select(F.lit(kind).alias("kind"), "option")

    days = readings.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    bounds = days.select(
        F.stack(
            F.lit(2),
            F.lit("first_day"),
            F.col("first_day").cast("string"),
            F.lit("last_day"),
            F.col("last_day").cast("string"),
        ).alias("kind", "option")
    )
    options = distinct(readings, "state", "state").unionByName(distinct(inside, "city", "city"))
    return options.unionByName(bounds).orderBy("kind", "option")


def rain_by_state(readings: DataFrame) -> DataFrame:
    rain = readings.groupBy("state").agg(F.sum("total_precipitation").alias("accumulated_precipitation_mm"))
    return _top(rain, "accumulated_precipitation_mm", ["state"], None)


def monthly_temperature(readings: DataFrame) -> DataFrame:
    months = readings.groupBy(F.year("full_date").alias("year"), F.month("full_date").alias("month"))
    mean = F.round(F.avg("avg_temperature"), 2)
    return months.agg(mean.alias("monthly_avg_temperature")).orderBy("year", "month")


def hottest_cities(readings: DataFrame, k: int = 10) -> DataFrame:
    means = readings.groupBy(*CITY).agg(F.round(F.avg("max_temperature"), 2).alias("avg_max_temperature"))
    return _top(means, "avg_max_temperature", CITY, k)


def wettest_cities(readings: DataFrame, k: int = 10) -> DataFrame:
    rain = readings.groupBy(*CITY).agg(F.sum("total_precipitation").alias("total_precipitation"))
    return _top(rain, "total_precipitation", CITY, k)


def dry_days(readings: DataFrame) -> DataFrame:
    """Days below 1 mm per city. Unlike the daily flag, a day without a rain reading is not dry here."""
    dry = F.count_if(F.col("total_precipitation") < risk.DRY_DAY_BELOW_MM)
    return _top(readings.groupBy(*CITY).agg(dry.alias("dry_days")), "dry_days", CITY, None)


SNAPSHOT = {
    "avg_temperature": (F.avg, " C"),
    "total_precipitation": (F.sum, " mm"),
    "avg_humidity": (F.avg, "%"),
    "risk_events": (F.sum, ""),
}


def latest_snapshot(readings: DataFrame) -> DataFrame:
    """One row: key figures of the latest day, of the day with readings before it (null if none), and deltas."""
    per_day = readings.groupBy("full_date").agg(*[agg(name).alias(name) for name, (agg, _) in SNAPSHOT.items()])
    two = per_day.orderBy(F.col("full_date").desc_nulls_last()).limit(2)
    has_previous = F.count("full_date") == 2

    def previous(name: str) -> Column:
        return F.when(has_previous, F.min_by(name, "full_date"))

    row = two.agg(
        F.max("full_date").alias("latest_date"),
        F.when(has_previous, F.min("full_date")).alias("previous_date"),
        *[F.max_by(name, "full_date").alias(name) for name in SNAPSHOT],
        *[previous(name).alias(f"previous_{name}") for name in SNAPSHOT],
    )
    deltas = {
        f"delta_{name}": labels.signed_delta(F.col(name), F.col(f"previous_{name}"), suffix)
        for name, (_, suffix) in SNAPSHOT.items()
    }
    return row.withColumns(deltas)


def risk_summary(readings: DataFrame) -> DataFrame:
    """Per city: monitored days, risk events, worst dry count, 7-day rain and temperature, first coordinates."""
    first = F.min(F.struct("full_date", "latitude", "longitude"))
    summary = (
        readings.groupBy(*CITY)
        .agg(
            F.countDistinct("full_date").alias("dias_monitorados"),
            F.sum("risk_events").alias("eventos_de_risco"),
            F.max("days_without_rain").alias("maior_sequencia_seca"),
            F.max("precipitation_accumulated_7d").alias("chuva_7d_max"),
            F.max("max_temperature").alias("temperatura_maxima"),
            first.alias("_first"),
        )
        .select("*", "_first.latitude", "_first.longitude")
        .drop("_first")
    )
    worst_first = [
        F.col(name).desc_nulls_last()
        for name in ("eventos_de_risco", "maior_sequencia_seca", "temperatura_maxima")
    ]
    return summary.orderBy(*worst_first, *CITY)


def risk_top(readings: DataFrame, k: int = 10) -> DataFrame:
    """The k riskiest cities that had any high risk."""
    label = labels.city_label(F.col("city"), F.col("state"))
    risky = risk_summary(readings).where(F.col("eventos_de_risco") > 0)
    worst_first = [
        F.col(name).desc_nulls_last()
        for name in ("eventos_de_risco", "maior_sequencia_seca", "temperatura_maxima")
    ]
    return risky.orderBy(*worst_first, *CITY).limit(k).withColumn("city_label", label)


def insights(readings: DataFrame) -> DataFrame:
    """Three rows: riskiest city (events), hottest reading (degrees), rainiest city (mm)."""

    def headline(kind: str, df: DataFrame, value: str) -> DataFrame:
        return df.select(F.lit(kind).alias("insight"), *CITY, F.col(value).cast("double").alias("value"))

    riskiest = risk_summary(readings).limit(1)
    hottest = _top(readings.where(F.col("max_temperature").isNotNull()), "max_temperature", ["full_date", *CITY], 1)
    rainiest = wettest_cities(readings, 1)
    return (
        headline("riskiest_city", riskiest, "eventos_de_risco")
        .unionByName(headline("hottest_reading", hottest, "max_temperature"))
        .unionByName(headline("rainiest_city", rainiest, "total_precipitation"))
    )


def daily_by_state(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("full_date", "state")
        .agg(
            F.avg("avg_temperature").alias("avg_temperature"),
            F.sum("total_precipitation").alias("total_precipitation"),
        )
        .orderBy("full_date", "state")
    )


def water_balance(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("full_date", "state")
        .agg(
            F.sum("total_precipitation").alias("total_precipitation"),
            F.sum("evapotranspiration").alias("evapotranspiration"),
        )
        .orderBy("full_date", "state")
    )


def temperature_ranking(readings: DataFrame, k: int | None = None) -> DataFrame:
    """Cities of the latest day, hottest first, with label, display text and band."""
    latest = at_latest(readings, "full_date")
    ranked = latest.groupBy(*CITY).agg(
        F.avg("avg_temperature").alias("avg_temperature"), F.max("max_temperature").alias("max_temperature")
    )
    labelled = ranked.withColumns(
        {
            "city_label": labels.city_label(F.col("city"), F.col("state")),
            "display": labels.one_decimal(F.col("avg_temperature"), " C"),
            "band": risk.temperature_band(F.col("avg_temperature")),
        }
    )
    return _top(labelled, "avg_temperature", CITY, k)


def rolling_3d(readings: DataFrame) -> DataFrame:
    """Mean temperature over the last three rows of a city (by name alone, whatever its state)."""
    three = [Rolling("temperature_rolling_3d", "avg", "avg_temperature", 3)]
    ties = [c for c in ("state", "latitude", "longitude", "source", "region") if c in readings.columns]
    return rolling_rows(readings, ["city"], "full_date", ties, three)


def trend_top_cities(readings: DataFrame, k: int = 6) -> DataFrame:
    """The smoothed series of the k cities that are hottest on the latest day. k bounds the broadcast."""
    hottest = temperature_ranking(readings, k).select("city").distinct()
    # Smoothing belongs to one city, so choosing the cities first changes nothing but the work.
    chosen = readings.join(F.broadcast(hottest), "city", "left_semi")
    return rolling_3d(chosen).orderBy("city", "full_date")


def risk_share(readings: DataFrame) -> DataFrame:
    """High alerts by type with their share of all high alerts; types without any are left out."""
    counts = readings.agg(*[F.count_if(F.col(name) == risk.HIGH).alias(name) for name in RISK_COLUMNS])
    total = sum((F.col(name) for name in RISK_COLUMNS[1:]), F.col(RISK_COLUMNS[0]))
    totalled = counts.withColumn("_total", total)
    renamed = totalled.withColumnsRenamed(risk.RISK_TYPES)
    long = renamed.unpivot(["_total"], list(risk.RISK_TYPES.values()), "risk_type", "events")
    percent = labels.percent_of(F.col("events"), F.col("_total"))
    return (
        long.where(F.col("events") > 0)
        .withColumn("percentage", percent)
        .withColumn("label", labels.events_label(F.col("events"), F.col("percentage")))
        .drop("_total")
        .orderBy("events", "risk_type")
    )


def city_rain(readings: DataFrame, k: int | None = 15) -> DataFrame:
    rain = readings.groupBy(*CITY).agg(
        F.sum("total_precipitation").alias("chuva_total"),
        F.max("precipitation_accumulated_30d").alias("chuva_30d_max"),
        F.max("days_without_rain").alias("dias_sem_chuva"),
    )
    return _top(rain, "chuva_total", CITY, k)


def risk_by_state(readings: DataFrame) -> DataFrame:
    """High risks of the latest day per state."""
    latest = at_latest(readings, "full_date")
    return latest.groupBy("state").agg(F.sum("risk_events").alias("risk_events")).orderBy("state")


def dataset_summary(readings: DataFrame, crops: DataFrame) -> DataFrame:
    """One row for the caption: latest day, distinct cities and states, row counts, distinct crops."""
    weather = readings.agg(
        F.max("full_date").alias("latest_date"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("state").alias("states"),
        F.count(F.lit(1)).alias("weather_rows"),
    )
    figures = crops.agg(
        F.struct(
            F.count(F.lit(1)).alias("agriculture_rows"), F.countDistinct("product_name").alias("crops")
        ).alias("figures")
    ).scalar()
    return weather.withColumn("_crops", figures).select("*", "_crops.agriculture_rows", "_crops.crops").drop("_crops")


def export_table(readings: DataFrame, headings: Mapping[str, str] = READING_HEADINGS) -> DataFrame:
    """The filtered readings as shown and exported: newest day first, then state and city."""
    ordered = readings.orderBy(
        F.col("full_date").desc_nulls_last(), F.col("state").asc_nulls_last(), F.col("city").asc_nulls_last()
    )
    return with_headings(ordered, headings)


# --- crop statistics --------------------------------------------------------------------------------------


def _production(crops: DataFrame, by: str, k: int | None, all_years: bool) -> DataFrame:
    counted = crops if all_years else at_latest(crops, "year")
    made = counted.groupBy(by).agg(F.sum("produced_quantity").alias("produced_quantity"))
    shown = made.withColumn("display", labels.millions(F.col("produced_quantity"), "M t"))
    return _top(shown, "produced_quantity", [by], k)


def production_by_crop(crops: DataFrame, k: int | None = 12, all_years: bool = False) -> DataFrame:
    """Crops by production in the latest year, or in all years together."""
    return _production(crops, "product_name", k, all_years)


def production_by_state(crops: DataFrame, k: int | None = 12, all_years: bool = False) -> DataFrame:
    """States by production in the latest year, or in all years together."""
    return _production(crops, "territory_name", k, all_years)


def crop_figures(crops: DataFrame) -> DataFrame:
    """One row for the latest year: year, crops, territories, total production."""
    latest = at_latest(crops, "year")
    return latest.agg(
        F.max("year").alias("year"),
        F.countDistinct("product_name").alias("crops"),
        F.countDistinct("territory_name").alias("territories"),
        F.sum("produced_quantity").alias("produced_quantity"),
    ).withColumn("display", labels.millions(F.col("produced_quantity"), " mi t"))


def crop_table(crops: DataFrame, headings: Mapping[str, str] = CROP_HEADINGS) -> DataFrame:
    latest = at_latest(crops, "year")
    return with_headings(_top(latest, "produced_quantity", ["territory_name", "product_name"], None), headings)


# --- crops meet climate -----------------------------------------------------------------------------------


def climate_by_state(readings: DataFrame) -> DataFrame:
    """Risk events, mean temperature and rain of the latest day per state."""
    return (
        at_latest(readings, "full_date")
        .groupBy("state")
        .agg(
            F.sum("risk_events").alias("eventos_de_risco"),
            F.avg("avg_temperature").alias("temperatura_media"),
            F.sum("total_precipitation").alias("chuva_total"),
        )
    )


def crops_with_climate(
    crops: DataFrame,
    climate: DataFrame,
    state_by_code: Mapping[str, str] = labels.STATE_BY_CODE,
) -> DataFrame:
    """Crops of the latest year with the climate of their state. Without climate: no events, no rain, and the
    mean temperature of the crop rows that have one (so a state counts once per crop)."""
    latest = at_latest(crops, "year").withColumn("state", labels.state_of(F.col("territory_code"), state_by_code))
    joined = latest.join(climate, "state", "left")
    mean = joined.agg(F.avg("temperatura_media")).scalar()
    return joined.withColumns(
        {
            "eventos_de_risco": F.coalesce("eventos_de_risco", F.lit(0).cast("long")),
            "temperatura_media": F.coalesce(F.col("temperatura_media"), mean),
            "chuva_total": F.coalesce(F.col("chuva_total"), F.lit(0).cast("double")),
        }
    ).withColumn("bubble_size", F.greatest("eventos_de_risco", F.lit(1).cast("long")))


def exposure_top(exposed: DataFrame, k: int = 15) -> DataFrame:
    """Crop rows with the most risk events, larger production first among equals."""
    order = [F.col(c).desc_nulls_last() for c in ("eventos_de_risco", "produced_quantity")]
    return exposed.orderBy(*order, "territory_name", "product_name").limit(k)


def climate_crop_score(exposed: DataFrame, k: int | None = 12) -> DataFrame:
    """Score 0..100 per state: half production, 0.3 risk events, 0.2 temperature, each relative to the others."""
    states = (
        exposed.where(F.col("state").isNotNull())
        .groupBy("state", "territory_name")
        .agg(
            F.sum("produced_quantity").alias("produced_quantity"),
            F.max("eventos_de_risco").alias("eventos_de_risco"),
            F.avg("temperatura_media").alias("temperatura_media"),
            F.avg("chuva_total").alias("chuva_total"),
        )
    )
    # At most one row per known territory code and name here, so a window over all of them is bounded; a scalar
    # subquery would compute crops and climate a second time.
    everywhere = Window.partitionBy(F.lit(0))
    coldest = F.min("temperatura_media").over(everywhere)
    spread = F.max("temperatura_media").over(everywhere) - coldest
    events = F.greatest(F.max("eventos_de_risco").over(everywhere), F.lit(1))
    weighted = states.withColumns(
        {
            "production_weight": F.try_divide("produced_quantity", F.max("produced_quantity").over(everywhere)),
            "temperature_weight": F.when(spread == 0, F.lit(0.0)).otherwise(
                F.try_divide(F.col("temperatura_media") - coldest, spread)
            ),
            "risk_weight": F.col("eventos_de_risco") / events,
        }
    )
    score = 100 * (
        0.5 * F.col("production_weight") + 0.3 * F.col("risk_weight") + 0.2 * F.col("temperature_weight")
    )
    scored = weighted.withColumn("score", F.bround(score, 1))
    return _top(scored, "score", ["state", "territory_name"], k)
