"""Identifiers: content ids for records, dense surrogate ids for dimension rows, ids made of the key for facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Digits of the md5 prefix that spreads new keys over 16**3 = 4096 numbering buckets.
BUCKET_DIGITS = 3


def weather_record_id() -> Column:
    """SHA-256 of the raw city, timestamp and coordinates, before any cast."""
    parts = [F.col(name).cast("string") for name in ("city", "timestamp", "latitude", "longitude")]
    return F.sha2(F.concat_ws("|", *parts), 256)


def packed_id(*parts: tuple[str, int]) -> Column:
    """Whole numbers side by side in one positive long, the first one highest; ``parts`` are columns and their bits.

    Different keys have different ids, so nothing has to be numbered, looked up or checked for collisions. A part that
    is negative or needs more bits ends the job.
    """
    if sum(bits for _, bits in parts) > 63:
        raise ValueError("an id has 63 bits")
    packed = F.lit(0).cast("long")
    for name, bits in parts:
        part = F.col(name).cast("long")
        too_large = F.raise_error(F.concat(F.lit(f"{name} does not fit {bits} bits: "), part.cast("string")))
        packed = F.shiftleft(packed, bits) + F.when(part.between(0, (1 << bits) - 1), part).when(part.isNotNull(), too_large)
    return packed


def hashed_id(year: str, *others: str) -> Column:
    """15 bits of the year over 48 bits of the md5 of the other columns; equal ids can only meet inside a year."""
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in others])
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return F.shiftleft(F.col(year).cast("long"), 48) + digits


def number_rows(rows: DataFrame, natural_key: list[str], id_column: str, first_id: Column | int = 1) -> DataFrame:
    """Give every row of ``rows`` (unique on ``natural_key``) a dense id starting at ``first_id``.

    One sort of all new rows in one task would not scale, so rows are numbered inside md5-prefix buckets and
    shifted by the rows of the buckets before theirs. The order (prefix, key) is a function of the rows alone,
    so a recomputed task hands out the same ids. The bucket table has at most 4096 rows, which bounds both the
    unpartitioned window over it and its broadcast.
    """
    key_text = F.concat_ws("|", *[F.col(name).cast("string") for name in natural_key])
    bucketed = rows.withColumn("_bucket", F.substring(F.md5(key_text), 1, BUCKET_DIGITS))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    first = F.lit(first_id) if isinstance(first_id, int) else first_id
    in_bucket = Window.partitionBy("_bucket").orderBy(*natural_key)
    return (
        bucketed.withColumn("_position", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(id_column, (first + F.col("_offset") + F.col("_position") - 1).cast("long"))
        .drop("_bucket", "_position", "_offset")
    )
