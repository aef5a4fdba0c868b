"""Warehouse tables on plain Parquet: every load writes new directories and one commit makes them current.

A commit is a single JSON file listing, for every table, the directories that hold its rows. Readers follow the
commit with the highest number, so a load is visible as a whole or not at all, and a reader that started before
it keeps reading the directories it resolved. Fact tables are kept by month (or year): a load rewrites only the
periods its batch touches and lists the directories of all others again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.errors import WarehouseLoadError
from agrilake.schemas import DIM_CROP, DIM_DATE, DIM_LOCATION, DIM_SOURCE, FACT_AGRICULTURE, FACT_WEATHER
from agrilake.sources.reading import read_or_none

_COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)
WHOLE = ""
PERIOD = "period"

TABLES = {
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "dim_source": DIM_SOURCE,
    "dim_crop": DIM_CROP,
    "fact_weather_daily": FACT_WEATHER,
    "fact_agriculture_production": FACT_AGRICULTURE,
}
# Period of a fact row, as SQL; dimensions have none and are rewritten whole.
PERIODS = {
    "fact_weather_daily": "cast(date_id div 100 as string)",
    "fact_agriculture_production": "cast(year as string)",
}


@dataclass(frozen=True)
class Snapshot:
    """What the current commit says: table -> period -> directory."""

    version: int
    entries: dict[str, dict[str, str]]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def snapshot(self) -> Snapshot:
        commits = f"{self.root}/_commits"
        reader = self.spark.read.schema(_COMMIT).option("recursiveFileLookup", True)
        log = read_or_none(lambda: reader.json(commits))
        if log is None:
            return Snapshot(0, {})
        # One row per table and period of the newest commit: a few hundred for decades of months.
        rows = log.where(F.col("version") == log.agg(F.max("version")).scalar()).collect()
        entries: dict[str, dict[str, str]] = {}
        for row in rows:
            entries.setdefault(row["table"], {})[row["period"]] = row["path"]
        return Snapshot(rows[0]["version"] if rows else 0, entries)

    def read(self, table: str, snapshot: Snapshot | None = None, periods: set[str] | None = None) -> DataFrame:
        """A table as of a snapshot (default: now), optionally only some of its periods."""
        held = (snapshot or self.snapshot()).entries.get(table, {})
        paths = [path for period, path in sorted(held.items()) if periods is None or period in periods]
        if not paths:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(*paths)

    def create_views(self, prefix: str = "") -> Snapshot:
        """Temporary views of all star tables, all from one snapshot, for ``spark.sql``."""
        snapshot = self.snapshot()
        for table in TABLES:
            self.read(table, snapshot).createOrReplaceTempView(f"{prefix}{table}")
        return snapshot

    def stage(self, table: str, df: DataFrame, version: int, periods: set[str] | None = None) -> dict[str, str]:
        """Write rows for a coming version; nobody sees them before the commit. Returns period -> directory.

        ``periods`` are the periods of ``df``, needed for fact tables. Every call has a directory of its own: a load
        that is refused later has touched nothing that another one, on the same base, may have committed.
        """
        target = f"{self.root}/{table}/version={version}-{uuid.uuid4().hex}"
        if table not in PERIODS:
            df.write.mode("errorifexists").parquet(target)
            return {WHOLE: target}
        dated = df.withColumn(PERIOD, F.expr(PERIODS[table]))
        dated.hint("rebalance", F.col(PERIOD)).write.mode("errorifexists").partitionBy(PERIOD).parquet(target)
        return {period: f"{target}/{PERIOD}={period}" for period in periods or ()}

    def periods_of(self, table: str, df: DataFrame) -> set[str]:
        """Periods the rows fall into; bounded by the calendar, not by the data."""
        return {row[0] for row in df.select(F.expr(PERIODS[table]).alias(PERIOD)).distinct().collect()}

    def commit(self, base: Snapshot, staged: dict[str, dict[str, str]]) -> Snapshot:
        """Make staged directories current. Refused when somebody else committed since ``base`` was read."""
        version = base.version + 1
        entries = {table: dict(held) for table, held in base.entries.items()}
        for table, held in staged.items():
            entries.setdefault(table, {}).update(held)
        rows = [
            (version, table, period, path)
            for table, held in entries.items()
            for period, path in held.items()
        ]
        if self.snapshot().version != base.version:
            raise WarehouseLoadError(f"another load has committed since version {base.version}")
        target = f"{self.root}/_commits/{version:012d}"
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("errorifexists").json(target)
        return Snapshot(version, entries)
