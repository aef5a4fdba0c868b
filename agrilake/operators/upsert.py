"""Keyed merges of a batch into a table, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.errors import WarehouseLoadError
from agrilake.functions.ids import number_rows
from agrilake.operators.gates import repeated_values


def require_unique(batch: DataFrame, key: list[str], label: str) -> None:
    """A batch that brings a key twice has no defined outcome and is refused."""
    example = repeated_values(batch, key).limit(1).collect()
    if example:
        shown = ", ".join(f"{name}={example[0][name]}" for name in key)
        raise WarehouseLoadError(f"{label}: more than one row for {shown}")


def refuse(message: str, *shown: str) -> Column:
    """An expression that ends the job, with the values of the columns ``shown``."""
    values = [F.concat(F.lit(f" {name}="), F.coalesce(F.col(name).cast("string"), F.lit("null"))) for name in shown]
    return F.raise_error(F.concat(F.lit(message), *values))


def refuse_repeated(rows: DataFrame, key: list[str], label: str) -> DataFrame:
    """``rows``, which end the job at the second row of a key.

    Rows come out hashed and sorted by ``key``, so a merge on it needs no exchange beyond this one, and a key met twice
    stops its task at once, however many rows share it.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    counted = rows.withColumn("_place", place)
    twice = refuse(f"{label}: more than one row for", *key)
    return counted.where(F.when(F.col("_place") > 1, twice.cast("boolean")).otherwise(True)).drop("_place")


def next_id(current: DataFrame, id_column: str) -> Column:
    """First free id of a table, as a scalar subquery."""
    return current.agg(F.coalesce(F.max(id_column), F.lit(0)) + 1).scalar()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a table's columns and types; a column the data does not have yet is null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def insert_if_absent(
    current: DataFrame, batch: DataFrame, key: list[str], schema: T.StructType, id_column: str | None = None
) -> DataFrame:
    """``current`` plus the rows of ``batch`` whose key it does not have yet."""
    new = batch.join(current.select(*key), key, "left_anti")
    if id_column:
        new = number_rows(new, key, id_column, next_id(current, id_column))
    return conform(current, schema).unionByName(conform(new, schema))


def upsert(
    current: DataFrame,
    batch: DataFrame,
    key: list[str],
    replaced: list[str],
    schema: T.StructType,
    id_column: str,
    new_id: Column | None = None,
) -> DataFrame:
    """Whole-row merge: a key in ``batch`` takes the batch's ``replaced`` columns, nulls included.

    Every other column (id, load time) stays as first loaded. ``new_id`` is the id of a new row as an expression over its
    columns, which costs nothing. Without it (dimensions, which are small) each batch row draws a number after the largest
    in ``current`` and keeps it only if its key is new; like a database sequence this leaves gaps.
    """
    if new_id is None:
        drawn = number_rows(batch, key, id_column, next_id(current, id_column))
    else:
        drawn = batch.withColumn(id_column, new_id)
    new = drawn.withColumn("_hit", F.lit(True)).alias("new")
    old = current.alias("old")
    in_batch = set(drawn.columns)

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name not in in_batch:
            return before
        if name in replaced:
            return F.when(F.col("new._hit"), after).otherwise(before)
        return F.coalesce(before, after)

    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]
    rows = old.join(new, same_key, "full_outer").select(*[merged(n).alias(n) for n in schema.fieldNames()])
    return conform(rows, schema)


def orphan_keys(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys the fact uses but the dimension lacks, with their fact ``rows``.

    The fact is counted per key before the join, so a key with a third of all rows is one row there.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")
