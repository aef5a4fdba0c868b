"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Shuffle partitions follow the data: AQE merges small ones and splits skewed joins and rebalances.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a builder; partition counts and memory stay the cluster's business."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
