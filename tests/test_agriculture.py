import pytest

from agrilake.operators.agriculture import agriculture_gold, agriculture_silver

BRONZE = (
    "year string, territory_code string, territory_name string, metric_code string, metric_name string, "
    "product_code string, product_name string, value double, unit string, data_source string, "
    "ingestion_timestamp string, pipeline_execution_id string"
)


def _bronze(spark, *changes):
    base = {
        "year": "2024", "territory_code": "51", "territory_name": "Mato Grosso", "metric_code": "214",
        "metric_name": "m", "product_code": "2713", "product_name": "Soja", "value": 1.0, "unit": "t",
        "data_source": "ibge_pam", "ingestion_timestamp": "2026-01-01T00:00:00", "pipeline_execution_id": "a",
    }
    names = [part.split()[0] for part in BRONZE.split(", ")]
    return spark.createDataFrame([[{**base, **c}[n] for n in names] for c in changes], BRONZE)


def test_golden_row(spark):
    metrics = {"214": 1000.0, "215": 3000.0, "216": 250.0, "112": 4000.0}
    silver = agriculture_silver(_bronze(spark, *[{"metric_code": m, "value": v} for m, v in metrics.items()]))
    rows = agriculture_gold(silver).collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert (row["produced_quantity"], row["harvested_area"], row["production_value"]) == (1000.0, 250.0, 3000.0)
    assert row["reported_yield_t_ha"] == pytest.approx(4.0) and row["calculated_yield_t_ha"] == pytest.approx(4.0)
    assert row["source"] == "ibge_pam" and row["year"] == 2024


def test_silver_validity(spark):
    silver = agriculture_silver(
        _bronze(
            spark,
            {"product_code": "kept", "territory_code": " 51 ", "year": "2024.0"},
            {"year": "1973"},
            {"year": "2101"},
            {"year": "x"},
            {"metric_code": "999"},
            {"metric_code": None},
            {"product_name": "  "},
            {"product_name": None},
            {"territory_code": None},
            {"product_code": None},
        )
    ).collect()
    assert [(r["product_code"], r["territory_code"], r["year"]) for r in silver] == [("kept", "51", 2024)]


def test_last_delivery_wins(spark):
    silver = agriculture_silver(
        _bronze(
            spark,
            {"value": 1.0, "ingestion_timestamp": "2026-01-02T00:00:00"},
            {"value": 9.0, "ingestion_timestamp": "2026-01-01T00:00:00", "pipeline_execution_id": "z"},
            {"value": 2.0, "ingestion_timestamp": "2026-01-02T00:00:00", "pipeline_execution_id": "b"},
        )
    ).collect()
    assert [r["value"] for r in silver] == [2.0]


def test_source_names_the_data_source_when_that_is_absent(spark):
    bronze = _bronze(spark, {}).withColumnRenamed("data_source", "source")
    assert agriculture_silver(bronze).first()["data_source"] == "ibge_pam"


def test_gold_missing_metrics_zero_area_and_null_keys(spark):
    silver = agriculture_silver(
        _bronze(
            spark,
            {"product_code": "zero", "value": 5.0},
            {"product_code": "zero", "metric_code": "216", "value": 0.0},
            {"product_code": "unmeasured", "value": None},
            {"product_code": "nameless", "territory_name": None},
        )
    )
    rows = {r["product_code"]: r for r in agriculture_gold(silver).collect()}
    assert set(rows) == {"zero", "unmeasured"}
    assert rows["zero"]["calculated_yield_t_ha"] is None
    assert rows["zero"]["reported_yield_kg_ha"] is None
    assert rows["unmeasured"]["produced_quantity"] is None


def test_nothing_in_nothing_out(spark):
    assert agriculture_gold(agriculture_silver(_bronze(spark, {}).limit(0))).count() == 0
