"""Row rules, rejection reasons and the split into accepted and quarantined records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrilake.config import Thresholds
from agrilake.operators.skew import HOT_KEY_ROWS, attach_key_facts

RECORD_KEY = ["city", "timestamp", "latitude", "longitude"]
DUPLICATE = "duplicate_record"


def _fails(condition: Column) -> Column:
    """True unless the condition holds; a condition that is null does not hold."""
    return ~F.coalesce(condition, F.lit(False))


def _key_rules() -> list[tuple[str, Column]]:
    return [
        ("timestamp_is_required", _fails(F.col("timestamp") != "")),
        ("city_is_required", _fails(F.col("city") != "")),
        ("latitude_out_of_range", _fails(F.col("latitude").between(-90, 90))),
        ("longitude_out_of_range", _fails(F.col("longitude").between(-180, 180))),
    ]


def _measure_rules(limits: Thresholds) -> list[tuple[str, Column]]:
    q = limits.quality
    humidity, rain = F.col("relative_humidity_2m"), F.col("precipitation_mm")
    wind, temperature = F.col("wind_speed_kmh"), F.col("temperature_2m")
    # A missing measure passes: its comparison is null, which F.when takes for not broken.
    return [
        ("relative_humidity_2m_out_of_range", ~humidity.between(q.min_humidity_pct, q.max_humidity_pct)),
        ("precipitation_mm_below_minimum", rain < q.min_precipitation_mm),
        ("wind_speed_kmh_below_minimum", wind < q.min_wind_speed_kmh),
        ("temperature_2m_out_of_range", ~temperature.between(q.min_temperature_c, q.max_temperature_c)),
    ]


def rule_reason(limits: Thresholds | None = None) -> Column:
    """Names of the broken rules in rule order, comma-separated; empty for a valid record."""
    rules = _key_rules() + _measure_rules(limits or Thresholds())
    return F.concat_ws(",", *[F.when(broken, F.lit(name)) for name, broken in rules])


def judge(
    records: DataFrame,
    order: str,
    limits: Thresholds | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add ``reason`` (empty if accepted) and ``accepted``; ``order`` is a unique column giving the arrival order.

    The first valid record of a key (city, timestamp, latitude, longitude) is accepted. Every later record of
    that key is rejected as a duplicate and as nothing else, valid or not; an invalid record does not claim its
    key. A key with a missing or impossible part can never be claimed, so those records (the usual hot key: all
    parts null) skip the duplicate search altogether.
    """
    marked = records.withColumn("reason", rule_reason(limits))
    claimable = F.lit(True)
    for _, broken in _key_rules():
        claimable = claimable & ~broken
    keys = {f"_k{i}": F.when(claimable, F.col(name)) for i, name in enumerate(RECORD_KEY)}
    keyed = marked.withColumns(keys)
    # Only keys seen more than once and claimed by a valid record decide anything; hot keys are needed to spread.
    claims = (
        keyed.where(claimable)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("reason") == "", F.col(order))).alias("_claimed_at"),
            F.count(F.lit(1)).alias("_records"),
        )
        .where(
            ((F.col("_records") > 1) & F.col("_claimed_at").isNotNull()) | (F.col("_records") > hot_key_rows)
        )
    )
    # Null keys match nothing in the outer join, but they would still meet in one shuffle partition: spread them.
    spread = F.concat(F.lit("unclaimable "), F.xxhash64(order).cast("string"))
    keyed = keyed.withColumn("_k0", F.coalesce("_k0", spread))
    joined = attach_key_facts(keyed, claims, list(keys), "_claimed_at", "_records", order, hot_key_rows)
    duplicate = F.coalesce(F.col("_claimed_at") < F.col(order), F.lit(False))
    return (
        joined.withColumn("reason", F.when(duplicate, DUPLICATE).otherwise(F.col("reason")))
        .withColumn("accepted", F.col("reason") == "")
        .select(*records.columns, "reason", "accepted")
    )


@dataclass(frozen=True)
class QualitySplit:
    accepted: DataFrame
    quarantined: DataFrame


def split_judged(judged: DataFrame, record_columns: list[str], execution_id: str) -> QualitySplit:
    """Accepted records as they came; rejected ones wrapped as record, reason, time and run."""
    rejected = judged.where(~F.col("accepted")).select(
        F.struct(*record_columns).alias("record"),
        "reason",
        F.split("reason", ",").alias("reasons"),
        F.current_timestamp().alias("validation_timestamp"),
        F.lit(execution_id).alias("pipeline_execution_id"),
    )
    return QualitySplit(judged.where("accepted").select(*record_columns), rejected)
