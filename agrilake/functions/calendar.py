"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(day: Column) -> Column:
    """yyyymmdd as an int."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """The date dimension's columns; weekday and week follow ISO 8601 (Monday is 1)."""
    iso_weekday = (F.weekday(day) + 1).cast("int")
    return {
        "date_id": date_id(day),
        "full_date": day,
        "day": F.dayofmonth(day),
        "day_of_week": iso_weekday,
        "week": F.weekofyear(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": iso_weekday >= 6,
    }
