import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from agrilake.config import LakeConfig
from agrilake.errors import WarehouseLoadError
from agrilake.operators import star
from agrilake.operators.upsert import conform, insert_if_absent, upsert
from agrilake.plans.warehouse_load import load_gold, load_warehouse, read_crops, read_readings
from agrilake.schemas import DIM_CROP, DIM_SOURCE, FACT_WEATHER, GOLD_AGRICULTURE, GOLD_WEATHER
from agrilake.sources.warehouse import Snapshot, Warehouse


def _gold(spark, *rows):
    """(day, city, temperature) plus fixed rest; day is a date."""
    base = {
        "state": "MT", "region": "CO", "latitude": -12.5425, "longitude": -55.7211, "source": "open_meteo",
        "max_temperature": 35.125, "avg_humidity": 66.5, "days_without_rain": 3, "thermal_amplitude": math.nan,
        "drought_risk": "normal", "heat_risk": "high", "heavy_rain_risk": "normal",
    }
    df = spark.createDataFrame(list(rows), "event_date date, city string, avg_temperature double")
    return conform(df.withColumns({k: F.lit(v) for k, v in base.items()}), GOLD_WEATHER)


def _crops(spark, *rows):
    df = spark.createDataFrame(list(rows), "year int, territory_code string, product_code string, product_name string, produced_quantity double")
    named = df.withColumns({"territory_name": F.lit("Mato Grosso"), "source": F.lit("ibge_pam"), "calculated_yield_t_ha": F.lit(4.00005)})
    return conform(named, GOLD_AGRICULTURE)


AUG, SEP = dt.date(2026, 8, 15), dt.date(2026, 9, 1)


def _fact(spark, root):
    warehouse = Warehouse(spark, root)
    return {(r["date_id"], r["location_id"]): r for r in warehouse.read("fact_weather_daily").collect()}


def test_load_and_repeat(spark, tmp_path):
    root = str(tmp_path)
    gold = _gold(spark, (AUG, "Sorriso", 29.444), (SEP, "Sorriso", 20.0), (SEP, "Vera", 21.0))
    assert load_warehouse(spark, root, gold, _crops(spark, (2024, "51", "2713", "Soja", 1000.0))) == 4
    warehouse = Warehouse(spark, root)
    first = _fact(spark, root)
    assert len(first) == 3
    one = next(r for (day, _), r in first.items() if day == 20260815)
    assert float(one["avg_temperature"]) == 29.44 and float(one["max_temperature"]) == 35.13
    assert one["thermal_amplitude"] is None and one["days_without_rain"] == 3
    assert {r["source_name"]: r["source_type"] for r in warehouse.read("dim_source").collect()} == {
        "open_meteo": "weather_api", "ibge_pam": "agriculture_statistics",
    }
    crop = warehouse.read("fact_agriculture_production").first()
    assert (crop["state_code"], crop["state_name"]) == ("51", "Mato Grosso")
    assert float(crop["calculated_yield_t_ha"]) == pytest.approx(4.0001)

    assert load_warehouse(spark, root, gold) == 3
    assert _fact(spark, root) == first
    assert warehouse.read("dim_location").count() == 2 and warehouse.read("dim_date").count() == 2


def test_overlap_updates_rows_and_keeps_identity(spark, tmp_path):
    root = str(tmp_path)
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0), (AUG, "Vera", 21.0)))
    before = _fact(spark, root)
    august = Warehouse(spark, root).snapshot().entries["fact_weather_daily"]["202608"]
    load_warehouse(spark, root, _gold(spark, (SEP, "Sorriso", 1.0)))
    # A load of September lists August's directory again without rewriting it.
    assert Warehouse(spark, root).snapshot().entries["fact_weather_daily"]["202608"] == august
    load_warehouse(spark, root, _gold(spark, (AUG, "Vera", 25.0), (AUG, "Lucas", 26.0)).withColumn("avg_humidity", F.lit(None).cast("double")))
    after = _fact(spark, root)
    assert len(after) == 4
    for key, old in before.items():
        assert after[key]["weather_fact_id"] == old["weather_fact_id"] and after[key]["loaded_at"] == old["loaded_at"]
    vera = next(k for k in before if float(before[k]["avg_temperature"]) == 21.0)
    assert float(after[vera]["avg_temperature"]) == 25.0 and after[vera]["avg_humidity"] is None
    ids = [r["weather_fact_id"] for r in after.values()]
    assert len(set(ids)) == len(ids)


def test_refused_batches_leave_the_warehouse_alone(spark, tmp_path):
    root = str(tmp_path)
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0)))
    version = Warehouse(spark, root).snapshot().version
    moved = _gold(spark, (SEP, "Sorriso", 20.0)).withColumn("latitude", F.lit(1.0))
    bad = {
        "dim_location": _gold(spark, (AUG, "Sorriso", 20.0)).union(moved),
        "fact_weather_daily": _gold(spark, (AUG, "Sorriso", 20.0), (AUG, "Sorriso", 21.0)),
        "two-letter": _gold(spark, (AUG, "Sorriso", 20.0)).withColumn("state", F.lit("MTX")),
        "without": _gold(spark, (AUG, None, 20.0)),
    }
    for message, batch in bad.items():
        with pytest.raises(WarehouseLoadError, match=message):
            load_warehouse(spark, root, batch)
    crops = {
        "dim_crop": _crops(spark, (2024, "51", "2713", None, 1000.0)),
        "fact_agriculture_production": _crops(spark, *[(2024, "51", "2713", "Soja", 1000.0)] * 2),
    }
    for message, batch in crops.items():
        with pytest.raises(WarehouseLoadError, match=message):
            load_warehouse(spark, root, _gold(spark, (SEP, "Sorriso", 20.0)), batch)
    overflow = _gold(spark, (AUG, "Sorriso", 123456.0))
    with pytest.raises(WarehouseLoadError, match="load failed"):
        load_warehouse(spark, root, overflow)
    assert Warehouse(spark, root).snapshot().version == version


def test_commit_refuses_a_stale_base(spark, tmp_path):
    root = str(tmp_path)
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0)))
    with pytest.raises(WarehouseLoadError, match="another load"):
        Warehouse(spark, root).commit(Snapshot(0, {}), {})


def test_a_refused_load_leaves_committed_rows_alone(spark, tmp_path):
    """Two loads on one base: the second stages after the first has committed, and is refused."""
    warehouse = Warehouse(spark, str(tmp_path))
    base = warehouse.snapshot()
    winner = warehouse.stage("dim_crop", spark.createDataFrame([(1, "a", "A")], DIM_CROP), base.version + 1)
    warehouse.commit(base, {"dim_crop": winner})
    loser = warehouse.stage("dim_crop", spark.createDataFrame([(1, "b", "B")], DIM_CROP), base.version + 1)
    with pytest.raises(WarehouseLoadError, match="another load"):
        warehouse.commit(base, {"dim_crop": loser})
    assert [r["crop_code"] for r in warehouse.read("dim_crop").collect()] == ["a"]


def test_older_files_gain_columns(spark, tmp_path):
    """A fact written before the rolling measures existed reads with nulls in their place."""
    root, old = str(tmp_path), [f for f in FACT_WEATHER.fieldNames() if "accumulated" not in f]
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0)))
    warehouse = Warehouse(spark, root)
    base = warehouse.snapshot()
    path = f"{root}/old"
    warehouse.read("fact_weather_daily").select(*old).write.parquet(path)
    warehouse.commit(base, {"fact_weather_daily": {"202608": path}})
    row = warehouse.read("fact_weather_daily").first()
    assert row["precipitation_accumulated_7d"] is None and row["heat_risk"] == "high"


def test_upsert_semantics(spark):
    current = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], DIM_CROP)
    batch = spark.createDataFrame([("b", None), ("c", "C")], "crop_code string, crop_name string")
    rows = {r["crop_code"]: (r["crop_id"], r["crop_name"]) for r in upsert(current, batch, ["crop_code"], ["crop_name"], DIM_CROP, "crop_id").collect()}
    assert rows["a"] == (1, "A") and rows["b"] == (2, None)  # a null replaces as well
    assert rows["c"][1] == "C" and rows["c"][0] > 2


def test_insert_if_absent_keeps_what_is_there(spark):
    current = spark.createDataFrame([(5, "open_meteo", "weather_api")], DIM_SOURCE)
    batch = spark.createDataFrame([("open_meteo", "other"), ("x", "other")], "source_name string, source_type string")
    rows = sorted(tuple(r) for r in insert_if_absent(current, batch, ["source_name"], DIM_SOURCE, "source_id").collect())
    assert rows == [(5, "open_meteo", "weather_api"), (6, "x", "other")]


def test_readings_come_from_the_warehouse_else_from_gold(spark, tmp_path):
    config = LakeConfig(str(tmp_path))
    gold = _gold(spark, (AUG, "Sorriso", 20.0), (SEP, "Vera", 21.0))
    gold.write.partitionBy("year", "month", "state").parquet(config.layer("gold", "weather_daily"))
    readings, origin = read_readings(spark, config)
    assert origin == "gold" and {"full_date", "city"} <= set(readings.columns) and readings.count() == 2
    assert read_crops(spark, config).count() == 0
    assert load_gold(spark, config) == 2
    readings, origin = read_readings(spark, config)
    assert origin == "warehouse" and [r["city"] for r in star.in_day_order(readings).collect()] == ["Sorriso", "Vera"]
    assert len(readings.columns) == 24


def test_star_tables_answer_sql(spark, tmp_path):
    root = str(tmp_path)
    rain = {"total_precipitation": F.when(F.col("city") == "Vera", 0.5).otherwise(12.25)}
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0), (SEP, "Vera", 21.25)).withColumns(rain))
    Warehouse(spark, root).create_views("wh_")
    star_join = "FROM wh_fact_weather_daily f JOIN wh_dim_location l ON l.location_id = f.location_id"
    states = spark.sql(f"SELECT l.state, SUM(f.total_precipitation) AS mm {star_join} GROUP BY l.state").collect()
    assert [(r["state"], float(r["mm"])) for r in states] == [("MT", 12.75)]
    dry = spark.sql(
        f"SELECT l.city, SUM(CASE WHEN f.total_precipitation < 1 THEN 1 ELSE 0 END) AS d {star_join} GROUP BY l.city ORDER BY d DESC"
    ).collect()
    assert [tuple(r) for r in dry] == [("Vera", 1), ("Sorriso", 0)]
    months = spark.sql(
        "SELECT d.year, d.month, ROUND(AVG(f.avg_temperature), 2) AS t FROM wh_fact_weather_daily f "
        "JOIN wh_dim_date d ON d.date_id = f.date_id GROUP BY d.year, d.month ORDER BY d.year, d.month"
    ).collect()
    assert [(r["month"], float(r["t"])) for r in months] == [(8, 20.0), (9, 21.25)]


def test_foreign_keys_hold_after_a_load(spark, tmp_path):
    root = str(tmp_path)
    load_warehouse(spark, root, _gold(spark, (AUG, "Sorriso", 20.0), (SEP, "Vera", 21.0)))
    warehouse = Warehouse(spark, root)
    references = {"date_id": "dim_date", "location_id": "dim_location", "source_id": "dim_source"}
    report = star.foreign_key_report(
        warehouse.read("fact_weather_daily"), {key: warehouse.read(table) for key, table in references.items()}
    )
    assert {r["orphan_rows"] for r in report.collect()} == {0}


def test_gold_is_read_once_by_a_load(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    gold = _gold(spark, (AUG, "Sorriso", 20.0), (AUG, "Vera", 21.0), (SEP, "Vera", 22.0))
    gold = spark.createDataFrame(gold.collect(), GOLD_WEATHER)
    counted = gold.withColumn("avg_temperature", F.udf(seen, "double")("avg_temperature"))
    assert load_warehouse(spark, str(tmp_path), counted) == 3
    assert read.value == 3


def test_facts_without_their_dimension_rows_are_refused(spark, tmp_path):
    staging = star.weather_staging(_gold(spark, (AUG, "Sorriso", 20.0), (AUG, "Vera", 21.0)))
    locations = spark.createDataFrame([(1, "Sorriso", "MT")], "location_id long, city string, state string")
    sources = spark.createDataFrame([(1, "open_meteo", "weather_api")], DIM_SOURCE)
    rows = star.weather_fact_rows(staging, locations, sources, F.current_timestamp())
    with pytest.raises(Exception, match="no location_id for city=Vera state=MT"):
        rows.write.parquet(str(tmp_path / "facts"))


def test_fact_ids_are_the_key(spark):
    """Ids differ wherever keys do, whatever the order of loads; the checks add no exchange to the merge's own."""
    days = spark.range(1, 60).selectExpr("cast(20260000 + id as int) as date_id")
    keys = days.crossJoin(spark.range(1, 40).selectExpr("id as location_id")).crossJoin(
        spark.range(1, 4).selectExpr("id as source_id")
    )
    rows = conform(keys, FACT_WEATHER).drop("weather_fact_id")
    empty = spark.createDataFrame([], FACT_WEATHER)
    facts = star.merge_weather_facts(empty, rows)
    assert facts.select("weather_fact_id").distinct().count() == rows.count() == facts.count()
    assert facts.where("weather_fact_id >> 36 <> date_id or weather_fact_id % 256 <> source_id").isEmpty()
    later = star.merge_weather_facts(facts.where("location_id < 20"), rows.where("location_id > 10"))
    assert later.select("weather_fact_id", "location_id").exceptAll(facts.select("weather_fact_id", "location_id")).isEmpty()
    with pytest.raises(Exception, match="source_id does not fit 8 bits"):
        star.merge_weather_facts(empty, rows.withColumn("source_id", F.lit(256).cast("long"))).collect()
