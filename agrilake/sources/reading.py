"""Reads that tolerate a dataset nobody has written yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.functions.numbers import nan_to_null


def read_or_none(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None when its path does not exist; Spark lists the path once either way."""
    try:
        return load()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_layer_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Hive-partitioned Parquet dataset with a fixed schema.

    The given schema spares a pass over file footers, and columns older files lack read as null.
    """
    found = read_or_none(lambda: spark.read.schema(schema).parquet(path))
    return None if found is None else nan_to_null(found).select(*schema.fieldNames())


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As above; empty when the dataset does not exist."""
    found = read_layer_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def read_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files below ``path``, united by column name, directory names ignored."""
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    found = read_or_none(lambda: reader.parquet(path))
    return spark.createDataFrame([], schema or T.StructType()) if found is None else nan_to_null(found)


def listed(spark: SparkSession, path: str) -> DataFrame | None:
    """Path, length, ``modificationTime`` and partition columns of a dataset's files, from the listing alone; None when
    the dataset is not there."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    found = read_or_none(lambda: files.load(path))
    return None if found is None else found.drop("content")


def in_months(months: list[int]) -> Column:
    """Whether year and month, the partition columns, are among ``months``, each given as year * 100 + month."""
    years: dict[int, list[int]] = {}
    for month in months:
        years.setdefault(month // 100, []).append(month % 100)
    found = F.lit(False)
    for year, its_months in years.items():
        found = found | (F.col("year") == year) & F.col("month").isin(its_months)
    return found


def as_written(files: DataFrame, item: Column) -> DataFrame:
    """(item, written_at): the newest file, in milliseconds, of every ``item`` of a listing."""
    newest = F.unix_millis(F.max("modificationTime")).alias("written_at")
    return files.groupBy(item.cast("string").alias("item")).agg(newest)


def updated_at(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``updated_at``: newest file of a dataset, null when there is none. Reads no file contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = read_or_none(lambda: files.load(path))
    if found is None:
        return spark.createDataFrame([(None,)], "updated_at timestamp")
    return found.agg(F.max("modificationTime").alias("updated_at"))


def unite(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column a frame lacks is null there."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
