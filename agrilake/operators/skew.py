"""Joining rows with per-key facts when one key may own a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is joined by broadcast, any other by shuffle.
HOT_KEY_ROWS = 2_000_000
_SPREAD = 1 << 16


def attach_key_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    value: str,
    row_count: str,
    spread_by: str,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Left join of ``rows`` with ``facts`` (one row per key) that no hot key can stall.

    ``facts[row_count]`` says how many of ``rows`` carry the key; every key with more than ``hot_key_rows`` of
    them must be in ``facts``. Those keys are broadcast: their row counts add up to at most the number of rows,
    so there are at most rows / hot_key_rows of them. Their rows are then spread over the second join by a hash
    of ``spread_by`` instead of meeting in one task; any other key brings at most ``hot_key_rows`` rows there.
    Keys must not be null.
    """
    hot = facts.where(F.col(row_count) > hot_key_rows).select(
        *keys, F.col(value).alias("_hot"), F.lit(True).alias("_is_hot")
    )
    rest = facts.where(F.col(row_count) <= hot_key_rows).select(
        *keys, F.lit(0).alias("_lane"), F.col(value).alias("_rest")
    )
    lane = F.when(F.col("_is_hot"), 1 + F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD))).otherwise(0)
    return (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_lane", lane.cast("int"))
        .join(rest, [*keys, "_lane"], "left")
        .withColumn(value, F.coalesce("_hot", "_rest"))
        .drop("_hot", "_is_hot", "_rest", "_lane")
    )
