"""Reference data: monitored locations and crop products."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrilake.config import AGRICULTURE_SOURCE
from agrilake.schemas import LOCATIONS, PRODUCTS

_PACKAGED = Path(__file__).resolve().parents[1] / "reference_data"


def _read(spark: SparkSession, path: str | None, packaged: str, schema) -> DataFrame:
    if path is not None:
        return spark.read.schema(schema).csv(path, header=True)
    # The packaged file is on the driver only, so its lines travel with the plan instead of its path.
    header, *lines = (_PACKAGED / packaged).read_text(encoding="utf-8").splitlines()
    rows = [dict(zip(header.split(","), line.split(","), strict=True)) for line in lines if line.strip()]
    text = spark.createDataFrame([[row[name] for name in schema.fieldNames()] for row in rows], schema.fieldNames())
    return text.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_locations(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _read(spark, path, "locations.csv", LOCATIONS)


def read_products(spark: SparkSession, path: str | None = None, source: str = AGRICULTURE_SOURCE) -> DataFrame:
    return _read(spark, path, "products.csv", PRODUCTS).where(F.col("source") == source)
