"""Lake writers. Each one is safe to repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from agrilake.config import AGRICULTURE_SOURCE, WEATHER_SOURCE

_RUN_PARTITIONS = ["ingest_date", "run"]
_MONTH_OF_STATE = ["year", "month", "state"]


def _utc_now() -> F.Column:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def stamp_weather(records: DataFrame, execution_id: str) -> DataFrame:
    return records.withColumns(
        {
            "ingestion_timestamp": _utc_now(),
            "source": F.lit(WEATHER_SOURCE),
            "pipeline_execution_id": F.lit(execution_id),
        }
    )


def stamp_agriculture(records: DataFrame, execution_id: str) -> DataFrame:
    return records.withColumns(
        {
            "data_source": F.coalesce("source", F.lit(AGRICULTURE_SOURCE)),
            "ingestion_timestamp": _utc_now(),
            "pipeline_execution_id": F.lit(execution_id),
        }
    )


def write_run(df: DataFrame, path: str, ingest_date: dt.date, execution_id: str) -> None:
    """Append one run's rows; the same run again replaces only what it wrote.

    The directories are ``ingest_date`` and ``run``, never a name that is also a data column: a partition
    value would silently win over the column (the statistics have a ``year`` of their own).
    """
    (
        df.withColumns({"ingest_date": F.lit(ingest_date), "run": F.lit(execution_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_RUN_PARTITIONS)
        .parquet(path)
    )


def write_quarantine(rejected: DataFrame, path: str, execution_id: str) -> None:
    """Rejected records as JSON lines of their run; a run without any writes nothing."""
    (
        rejected.withColumn("run", F.lit(execution_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .json(path)
    )


def write_by_month(df: DataFrame, path: str) -> int:
    """Weather silver or gold by year, month and state; only months present in ``df`` are replaced.

    REBALANCE gathers a directory's rows into few files like a repartition by the same columns would, but lets
    AQE cut a state-month that outgrows the advisory size into several tasks. Returns the rows written.
    """
    written = Observation()
    (
        df.hint("rebalance", *[F.col(name) for name in _MONTH_OF_STATE])
        # After the shuffle: the writing stage counts each row once even when lost map tasks run again.
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_MONTH_OF_STATE)
        .parquet(path)
    )
    return written.get["rows"]


def append_by_month(df: DataFrame, path: str) -> None:
    """Add rows to a dataset kept by year, month and state."""
    gathered = df.hint("rebalance", *[F.col(name) for name in _MONTH_OF_STATE])
    gathered.write.mode("append").partitionBy(*_MONTH_OF_STATE).parquet(path)


def write_whole(df: DataFrame, path: str) -> int:
    """Replace a dataset. Returns the rows written, counted during the write."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return written.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
