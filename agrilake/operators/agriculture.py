"""Crop statistics: long and dirty in bronze, typed in silver, one wide row per territory and crop in gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrilake.config import AGRICULTURE_SOURCE
from agrilake.functions.numbers import null_if_nan, ratio
from agrilake.operators.silver import latest_per_key, newest_run_first
from agrilake.schemas import AGRICULTURE_KEYS, AGRICULTURE_METRICS, SILVER_AGRICULTURE

FIRST_YEAR, LAST_YEAR = 1974, 2100
STATISTIC_KEY = ["year", "territory_code", "metric_code", "product_code"]
#: Place of a row within one run's deliveries, where bronze has it.
_DELIVERY = ["payload_file", "payload_row"]
_TRIMMED = [
    "territory_code",
    "territory_name",
    "metric_code",
    "metric_name",
    "product_code",
    "product_name",
    "unit",
    "data_source",
]


def typed_statistics(bronze: DataFrame) -> DataFrame:
    named = bronze
    if "data_source" not in bronze.columns and "source" in bronze.columns:
        named = bronze.withColumnRenamed("source", "data_source")
    # pandas-style coercion goes over double, so '2024.0' is a year as well; a fraction is not.
    year = F.col("year").try_cast("double")
    columns = {name: F.trim(F.col(name).cast("string")) for name in _TRIMMED}
    columns["year"] = F.when(year == F.floor(year), year).try_cast("int")
    columns["value"] = null_if_nan(F.col("value").try_cast("double"))
    kept = [*SILVER_AGRICULTURE.fieldNames(), *[c for c in _DELIVERY if c in named.columns]]
    return named.select(*[columns.get(name, F.col(name)).alias(name) for name in kept])


def agriculture_silver(bronze: DataFrame) -> DataFrame:
    """Typed, valid statistics; of a key, the newest run's last file and last row in it win."""
    typed = typed_statistics(bronze)
    valid = typed.dropna(subset=STATISTIC_KEY).where(
        F.col("year").between(FIRST_YEAR, LAST_YEAR)
        & F.col("metric_code").isin(*AGRICULTURE_METRICS)
        & (F.col("product_name") != "")
    )
    delivered = [F.col(c).desc_nulls_last() for c in _DELIVERY if c in valid.columns]
    order = [*newest_run_first(valid), *delivered, F.col("value").desc_nulls_last()]
    return latest_per_key(valid, STATISTIC_KEY, order).drop(*_DELIVERY)


def agriculture_gold(silver: DataFrame) -> DataFrame:
    """Metrics side by side with yields; rows with a missing key part belong to no group.

    Conditional sums instead of pivot(): the codes are known, so one aggregation with one shuffle does it.
    """
    sums = [
        F.sum(F.when(F.col("metric_code") == code, F.col("value"))).cast("double").alias(name)
        for code, name in AGRICULTURE_METRICS.items()
    ]
    wide = (
        silver.where(F.col("metric_code").isin(*AGRICULTURE_METRICS))
        .dropna(subset=AGRICULTURE_KEYS)
        .groupBy(*AGRICULTURE_KEYS)
        .agg(*sums)
    )
    return wide.withColumns(
        {
            "calculated_yield_t_ha": ratio(F.col("produced_quantity"), F.col("harvested_area")),
            "reported_yield_t_ha": F.col("reported_yield_kg_ha") / 1000,
            "source": F.lit(AGRICULTURE_SOURCE),
        }
    )
