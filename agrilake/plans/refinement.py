"""Weather silver and gold, either whole or only the months that new bronze runs touch.

A month of silver is its old rows and the new ones, deduplicated. A month of gold changes when its silver does, or when a
rolling frame of one of its rows reaches into a changed month. Frames are rows, not days, so how far they reach depends
on how dense a city's rows are; ``months_reached`` measures it. All lists of months on the driver are bounded by the
calendar. A city with fewer rows than a frame makes the search go through all earlier months, of which only the keys are
read.

Runs are noted when their refinement starts and when it is over. One that broke in between may have left a month half
written, so the next refinement rebuilds everything from bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.config import LakeConfig
from agrilake.functions.numbers import nan_to_null
from agrilake.operators import gates
from agrilake.operators.gold import ROLLING, weather_gold
from agrilake.operators.silver import deduplicate_weather, is_valid_weather, typed_weather, weather_silver
from agrilake.schemas import BRONZE_WEATHER, DAILY_KEYS, SILVER_WEATHER
from agrilake.sources import lake
from agrilake.sources.metadata import MetadataStore
from agrilake.sources.reading import as_written, in_months, listed, read_layer

CITY = ["city", "state"]
REACH = max(m.rows for m in ROLLING) - 1
STEP = "refine_weather"


def _months_of(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(F.col("year") * 100 + F.col("month")).distinct().collect())


def blocks(months: set[int], present: list[int]) -> list[list[int]]:
    """``months`` split where a month of ``present`` lies between two of them."""
    found: list[list[int]] = []
    place = {month: i for i, month in enumerate(present)}
    for month in sorted(months):
        if found and place[month] == place[found[-1][-1]] + 1:
            found[-1].append(month)
        else:
            found.append([month])
    return found


def months_reached(silver: DataFrame, cities: DataFrame, outward: list[int], rows: int) -> list[int]:
    """As many of the ``outward`` months, nearest first, as hold ``rows`` daily rows of each of ``cities``; else all."""
    taken = 1
    while taken < len(outward):
        days = silver.where(in_months(outward[:taken])).select(*DAILY_KEYS).distinct()
        held = days.groupBy(*CITY).agg(F.count(F.lit(1)).alias("held"))
        same = [cities[c].eqNullSafe(held[c]) for c in CITY]
        if cities.join(held, same, "left").where(F.coalesce("held", F.lit(0)) < rows).isEmpty():
            break
        taken *= 2
    return outward[:taken]


def gold_of(silver: DataFrame, changed: list[int], touched: DataFrame, present: list[int], limits) -> tuple[list[int], DataFrame]:
    """The months of gold that differ once ``changed`` months of ``silver`` have new rows of the cities ``touched``,
    and their rows."""
    rewritten: set[int] = set(changed)
    for block in blocks(set(changed), present):
        later = [m for m in present if m > block[-1]]
        rewritten |= set(months_reached(silver, touched, later, REACH))
    parts = []
    for block in blocks(rewritten, present):
        earlier = [m for m in reversed(present) if m < block[0]]
        cities = silver.where(in_months(block)).select(*CITY).distinct()
        before = months_reached(silver, cities, earlier, REACH)
        parts.append(weather_gold(silver.where(in_months([*before, *block])), limits).where(in_months(block)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return sorted(rewritten), rows


def rebuild_weather(spark: SparkSession, config: LakeConfig) -> dict[str, int]:
    """Bronze to silver to gold over the whole history; a failed gate stops before the next layer."""
    limits = config.thresholds
    bronze, silver, gold = _layers(config)
    gates.check_path(spark, bronze, gates.bronze_weather_gate(limits))
    silver_rows = lake.write_by_month(weather_silver(read_layer(spark, bronze, BRONZE_WEATHER), limits), silver)
    gates.check_path(spark, silver, gates.silver_weather_gate(limits))
    gold_rows = lake.write_by_month(weather_gold(read_layer(spark, silver, SILVER_WEATHER), limits), gold)
    gates.check_path(spark, gold, gates.gold_weather_gate(limits))
    return {"silver": silver_rows, "gold": gold_rows}


def _layers(config: LakeConfig) -> tuple[str, str, str]:
    return config.layer("bronze", "weather"), config.layer("silver", "weather"), config.layer("gold", "weather_daily")


def refine_weather(spark: SparkSession, config: LakeConfig, whole: bool = False) -> dict[str, int]:
    """Bronze runs not refined yet to silver and gold, with blocking gates over what is written.

    Returns the rows written per layer. ``whole`` rebuilds everything; so does the first refinement, and one after a
    refinement that broke.
    """
    store = MetadataStore(spark, config.metadata_root)
    bronze, silver, gold = _layers(config)
    runs = listed(spark, bronze)
    if runs is None:
        return rebuild_weather(spark, config)  # whose gate says that there is nothing
    runs = as_written(runs, F.col("run"))
    pending, broken = store.pending(STEP, runs)
    if whole or broken or listed(spark, gold) is None:
        every = [tuple(r) for r in runs.collect()]  # one row per run of the job
        store.note(STEP, every, "started")
        result = rebuild_weather(spark, config)
        store.note(STEP, every, "done")
        return result
    if not pending:
        return {"silver": 0, "gold": 0}
    return _refine_runs(spark, config, store, pending)


def _refine_runs(spark: SparkSession, config: LakeConfig, store: MetadataStore, pending: list[tuple]) -> dict[str, int]:
    limits = config.thresholds
    bronze_path, silver_path, gold_path = _layers(config)
    staging = f"{config.staging_root(spark)}/refine_{pending[0][0]}"
    schema = T.StructType([*BRONZE_WEATHER.fields, T.StructField("run", T.StringType())])
    bronze = spark.read.schema(schema).parquet(bronze_path).where(F.col("run").isin([run for run, _ in pending]))
    bronze = nan_to_null(bronze).select(*BRONZE_WEATHER.fieldNames())
    gates.check(bronze, gates.bronze_weather_gate(limits))

    columns = SILVER_WEATHER.fieldNames()
    typed_weather(bronze).where(is_valid_weather(limits)).select(*columns).write.mode("overwrite").parquet(f"{staging}/new")
    new = spark.read.schema(SILVER_WEATHER).parquet(f"{staging}/new")
    changed = _months_of(new)
    if not changed:
        store.note(STEP, pending, "done")
        return {"silver": 0, "gold": 0}
    # The merged months are written aside first: a layer is never read by the job that replaces its directories.
    held = read_layer(spark, silver_path, SILVER_WEATHER).where(in_months(changed))
    merged = deduplicate_weather(held.unionByName(new)).select(*columns)
    merged.write.mode("overwrite").parquet(f"{staging}/merged")
    merged = spark.read.schema(SILVER_WEATHER).parquet(f"{staging}/merged")
    gates.check(merged, gates.silver_weather_gate(limits))

    store.note(STEP, pending, "started")
    silver_rows = lake.write_by_month(merged, silver_path)
    present = _months_of(listed(spark, silver_path))
    touched = new.select(*CITY).distinct()
    silver = read_layer(spark, silver_path, SILVER_WEATHER)
    months, rows = gold_of(silver, changed, touched, present, limits)
    gold_rows = lake.write_by_month(rows, gold_path)
    gates.check(spark.read.parquet(gold_path).where(in_months(months)), gates.gold_weather_gate(limits))
    store.note(STEP, pending, "done")
    return {"silver": silver_rows, "gold": gold_rows}
