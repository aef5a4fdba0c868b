import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrilake.operators import reports
from agrilake.operators.upsert import conform
from agrilake.schemas import GOLD_AGRICULTURE, GOLD_WEATHER

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)


def _readings(spark, *rows):
    names = "full_date date, city string, state string, avg_temperature double, total_precipitation double, heat_risk string, heavy_rain_risk string"
    df = spark.createDataFrame(list(rows), names).withColumn("event_date", F.col("full_date"))
    full = conform(
        df.withColumns({"max_temperature": F.col("avg_temperature") + 1, "avg_humidity": F.lit(50.0), "drought_risk": F.lit("normal"), "days_without_rain": F.lit(1)}),
        GOLD_WEATHER,
    )
    dated = full.withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
    return reports.with_risk(dated.withColumnRenamed("event_date", "full_date"))


@pytest.fixture(scope="module")
def readings(spark):
    return _readings(
        spark,
        (D1, "A", "MT", 20.0, 0.0, "normal", "normal"),
        (D2, "A", "MT", 22.0, None, "high", "normal"),
        (D3, "A", "MT", 30.0, 0.5, "high", "high"),
        (D2, "B", "GO", 10.0, 9.0, "normal", "high"),
        (D3, "B", "GO", 28.0, 1.0, "normal", "normal"),
    ).cache()


def test_missing_risk_columns_count_as_normal(spark, readings):
    bare = readings.drop("heat_risk", "heavy_rain_risk", "drought_risk", "risk_events", "risk_level")
    rows = reports.with_risk(bare).select("heat_risk", "risk_events", "risk_level").distinct().collect()
    assert [tuple(r) for r in rows] == [("normal", 0, "Normal")]


def test_filter(readings):
    assert reports.filter_readings(readings).count() == 5
    assert reports.filter_readings(readings, D2, D2).count() == 2
    assert reports.filter_readings(readings, states=["GO"], levels=["Atencao"]).count() == 1
    assert reports.filter_readings(readings, cities=["A"], levels=["Critico"]).collect()[0]["full_date"] == D3


def test_date_filter_prunes_year_directories(spark, readings, tmp_path):
    readings.write.partitionBy("year", "month").parquet(str(tmp_path / "gold"))
    picked = reports.filter_readings(spark.read.parquet(str(tmp_path / "gold")), start=dt.date(2025, 1, 1))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and picked.count() == 0


def test_a_range_of_days_reads_its_months_only(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE'2025-11-01', DATE'2026-03-31')) AS full_date")
    dated = days.withColumns({"year": F.year("full_date"), "month": F.month("full_date")})
    dated.write.partitionBy("year", "month").parquet(str(tmp_path / "gold"))
    for other in ("year=2025/month=11", "year=2026/month=2", "year=2026/month=3"):
        for file in (tmp_path / "gold" / other).glob("*.parquet"):
            file.write_text("whoever opens this fails")
    gold = spark.read.schema(dated.schema).parquet(str(tmp_path / "gold"))
    assert reports.filter_readings(gold, dt.date(2025, 12, 25), dt.date(2026, 1, 7)).count() == 14
    with pytest.raises(Exception):
        reports.filter_readings(gold, dt.date(2025, 12, 25), dt.date(2026, 2, 7)).count()


def test_dry_days_ignore_missing_rain(readings):
    assert {r["city"]: r["dry_days"] for r in reports.dry_days(readings).collect()} == {"A": 2, "B": 0}


def test_snapshot(spark, readings):
    row = reports.latest_snapshot(readings).first()
    assert (row["latest_date"], row["previous_date"]) == (D3, D2)
    assert (row["avg_temperature"], row["previous_avg_temperature"]) == (29.0, 16.0)
    assert row["delta_avg_temperature"] == "+13.0 C" and row["delta_risk_events"] == "+0.0"
    alone = reports.latest_snapshot(readings.where(F.col("full_date") == D1)).first()
    assert alone["previous_date"] is None and alone["previous_risk_events"] is None
    assert alone["delta_total_precipitation"] is None


def test_rankings_and_summary(readings):
    top = reports.risk_summary(readings).first()
    assert (top["city"], top["eventos_de_risco"], top["dias_monitorados"]) == ("A", 3, 3)
    assert [r["city_label"] for r in reports.risk_top(readings).collect()] == ["A/MT", "B/GO"]
    kinds = {r["insight"]: (r["city"], r["value"]) for r in reports.insights(readings).collect()}
    assert kinds == {"riskiest_city": ("A", 3.0), "hottest_reading": ("A", 31.0), "rainiest_city": ("B", 10.0)}
    ranking = reports.temperature_ranking(readings).collect()
    assert [(r["city"], r["display"], r["band"]) for r in ranking] == [("A", "30.0 C", "hot"), ("B", "28.0 C", "hot")]
    assert [r["city"] for r in reports.temperature_ranking(readings, 1).collect()] == ["A"]


def test_trend_keeps_the_hottest_cities_only(readings):
    trend = reports.trend_top_cities(readings, k=1).collect()
    assert [(r["city"], r["temperature_rolling_3d"]) for r in trend] == [("A", 20.0), ("A", 21.0), ("A", 24.0)]


def test_risk_share_leaves_out_empty_types(readings):
    rows = {r["risk_type"]: (r["events"], r["percentage"], r["label"]) for r in reports.risk_share(readings).collect()}
    assert rows == {"Calor": (2, 50.0, "2 eventos (50.0%)"), "Chuva forte": (2, 50.0, "2 eventos (50.0%)")}
    assert reports.risk_share(readings.where("city = 'none'")).count() == 0


def test_export_headings(readings):
    table = reports.export_table(readings)
    assert table.columns == list(reports.READING_HEADINGS.values())
    assert [r["Cidade"] for r in table.collect()][:2] == ["B", "A"]
    assert reports.with_headings(reports.risk_summary(readings), reports.RISK_SUMMARY_HEADINGS).columns[3] == "Eventos de risco"


def _crops(spark, *rows):
    df = spark.createDataFrame(list(rows), "year int, territory_code string, product_name string, produced_quantity double")
    named = df.withColumns({"territory_name": F.concat(F.lit("T"), "territory_code"), "product_code": F.col("product_name")})
    return conform(named, GOLD_AGRICULTURE)


def test_crops_with_climate_fill(spark, readings):
    crops = _crops(spark, (2024, "51", "Soja", 100.0), (2024, "51", "Sorgo", 50.0), (2024, "52", "Soja", 80.0), (2024, "35", "Soja", 10.0), (2024, "99", "Soja", 5.0), (2023, "51", "Soja", 1.0))
    exposed = reports.crops_with_climate(crops, reports.climate_by_state(readings))
    rows = {(r["territory_code"], r["product_name"]): r for r in exposed.collect()}
    assert len(rows) == 5 and rows["99", "Soja"]["state"] is None
    mean = (30.0 + 30.0 + 28.0) / 3  # a state counts once per crop row
    assert rows["35", "Soja"]["temperatura_media"] == pytest.approx(mean)
    assert (rows["35", "Soja"]["eventos_de_risco"], rows["35", "Soja"]["chuva_total"], rows["35", "Soja"]["bubble_size"]) == (0, 0.0, 1)
    assert rows["51", "Soja"]["bubble_size"] == 2
    scores = {r["state"]: r["score"] for r in reports.climate_crop_score(exposed).collect()}
    assert set(scores) == {"MT", "GO", "SP"}
    assert scores["MT"] == 100.0 and scores["GO"] == pytest.approx(100 * 0.5 * 80 / 150, abs=0.05)
    assert [r["product_name"] for r in reports.exposure_top(exposed, 2).collect()] == ["Soja", "Sorgo"]


def test_score_without_spread_or_climate(spark, readings):
    crops = _crops(spark, (2024, "51", "Soja", 100.0), (2024, "35", "Soja", 50.0))
    one_state = reports.climate_by_state(readings.where("state = 'MT'"))
    scores = {r["state"]: r["score"] for r in reports.climate_crop_score(reports.crops_with_climate(crops, one_state)).collect()}
    assert scores == {"MT": 80.0, "SP": 25.0}  # all at one temperature: that part counts nothing
    nothing = reports.climate_by_state(readings.where("state = 'none'"))
    assert {r["score"] for r in reports.climate_crop_score(reports.crops_with_climate(crops, nothing)).collect()} == {None}


def test_crop_figures_and_summary(spark, readings):
    crops = _crops(spark, (2023, "51", "Soja", 1.0), (2024, "51", "Soja", 1_500_000.0), (2024, "52", "Sorgo", 1_000_000.0))
    figures = reports.crop_figures(crops).first()
    assert (figures["year"], figures["crops"], figures["territories"], figures["display"]) == (2024, 2, 2, "2.5 mi t")
    assert [r["product_name"] for r in reports.production_by_crop(crops).collect()] == ["Soja", "Sorgo"]
    sums = lambda **how: [r["produced_quantity"] for r in reports.production_by_crop(crops, **how).collect()]
    assert sums() == [1_500_000.0, 1_000_000.0] and sums(all_years=True) == [1_500_001.0, 1_000_000.0]
    assert reports.production_by_state(crops, 1).first()["territory_name"] == "T51"
    assert reports.crop_table(crops).columns == list(reports.CROP_HEADINGS.values())
    summary = reports.dataset_summary(readings, crops).first()
    assert tuple(summary) == (D3, 2, 2, 5, 3, 2)
