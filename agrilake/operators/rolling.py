"""Rolling aggregates, by rows or by days, that never put an unbounded group into one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rolling:
    """``aggregate`` ('sum' or 'avg') of ``source`` over the current row and the ``rows - 1`` before it."""

    name: str
    aggregate: str
    source: str
    rows: int

    def over(self, window: WindowSpec) -> Column:
        aggregate = {"sum": F.sum, "avg": F.avg}[self.aggregate]
        return aggregate(self.source).over(window.rowsBetween(1 - self.rows, 0))


def rolling_rows(
    df: DataFrame, group: list[str], day: str, ties: list[str], measures: list[Rolling]
) -> DataFrame:
    """Add ``measures`` over ``group`` ordered by ``day`` and ``ties`` (together unique inside a group).

    A plain window would sort a whole group in one task, however many rows share it. Here a first window works
    per (group, day) and is right for every row with enough predecessors on its own day. Only the first and the
    last ``reach`` rows of a day can take part in a frame that crosses midnight, and in the order of the group
    these border rows hold every predecessor such a frame needs. So a second window over the border rows alone
    settles the rest: at most ``2 * reach`` rows per group and calendar day, whatever the group's size. The
    other rows travel through the second window under their own day, so no union and no second scan is needed.
    """
    reach = max(m.rows for m in measures) - 1
    if reach == 0:
        raise ValueError("a rolling frame needs at least two rows")
    within_day = Window.partitionBy(*group, day).orderBy(*ties)
    first_pass = df.withColumns(
        {
            "_place": F.row_number().over(within_day),
            "_followed": F.lead(F.lit(True), reach).over(within_day),
            **{f"_day_{m.name}": m.over(within_day) for m in measures},
        }
    )
    border = (F.col("_place") <= reach) | F.col("_followed").isNull()
    chunked = first_pass.withColumns({"_border": border, "_chunk": F.when(~border, F.col(day))})
    across_days = Window.partitionBy(*group, "_border", "_chunk").orderBy(day, *ties)
    second_pass = chunked.withColumns({f"_all_{m.name}": m.over(across_days) for m in measures})
    settled = {
        m.name: F.when(F.col("_place") <= reach, F.col(f"_all_{m.name}")).otherwise(F.col(f"_day_{m.name}"))
        for m in measures
    }
    return second_pass.select(*[F.col(c) for c in df.columns], *[c.alias(name) for name, c in settled.items()])


@dataclass(frozen=True)
class RollingDays:
    """``aggregate`` ('sum' or 'avg') of ``source`` over the rows of the current day and the ``days - 1`` before it."""

    name: str
    aggregate: str
    source: str
    days: int


def rolling_days(df: DataFrame, group: list[str], day: str, measures: list[RollingDays]) -> DataFrame:
    """Add ``measures`` over calendar days: a day without rows counts as a day, unlike in ``rolling_rows``.

    Rows of one day share their frame, so a range frame is a frame over daily sums and counts. These are aggregated
    before any shuffle, and the window over them sees one row per group and calendar day, whatever the group's size.
    Rows without a day have a frame of their own, made of each other.
    """
    sources = list(dict.fromkeys(m.source for m in measures))
    partial = [f(source).alias(f"_{kind}_{source}") for source in sources for kind, f in (("sum", F.sum), ("n", F.count))]
    daily = df.groupBy(*group, day).agg(*partial)
    by_day = Window.partitionBy(*group).orderBy("_number")

    def value(m: RollingDays) -> Column:
        frame = by_day.rangeBetween(1 - m.days, 0)
        total = F.sum(f"_sum_{m.source}").over(frame)
        return total if m.aggregate == "sum" else F.try_divide(total, F.sum(f"_n_{m.source}").over(frame))

    numbered = daily.withColumn("_number", F.unix_date(F.col(day)))
    rolled = numbered.select(*group, day, *[value(m).alias(m.name) for m in measures]).alias("rolled")
    rows = df.alias("rows")
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"rolled.{c}")) for c in (*group, day)]
    return rows.join(rolled, same).select("rows.*", *[f"rolled.{m.name}" for m in measures])
