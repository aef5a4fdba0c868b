import json

import pytest

from agrilake.sources.landed import (
    landed_files,
    read_statistics_payloads,
    read_statistics_rows,
    read_weather_payloads,
    statistics_records,
    weather_records,
)
from agrilake.sources.reference import read_locations, read_products

PLACE = ("Sorriso", "MT", -12.5, -55.7, "Centro-Oeste")


def _land(root, payload, city="Sorriso", state="MT", name="p.json"):
    target = root / f"city={city}" / f"state={state}"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(json.dumps(payload, indent=1))


def _records(spark, root):
    locations = spark.createDataFrame([PLACE], "city string, state string, latitude double, longitude double, region string")
    return [r.asDict() for r in weather_records(read_weather_payloads(spark, str(root)), locations).orderBy("record_order").collect()]


def test_payload_arrays_become_rows(spark, tmp_path):
    hourly = {
        "time": ["2026-08-15T00:00", "2026-08-15T01:00"],
        "temperature_2m": [25.4, 25.0],
        "precipitation": [1.2],
        "wind_speed_10m": [9.5, 9.0, 8.5],
        "surface_pressure": None,
    }
    _land(tmp_path, {"latitude": -12.54, "longitude": -55.72, "hourly": hourly})
    first, second = _records(spark, tmp_path)
    assert (first["city"], first["region"], first["timestamp"]) == ("Sorriso", "Centro-Oeste", "2026-08-15T00:00")
    assert (first["temperature_2m"], first["precipitation_mm"], first["wind_speed_kmh"]) == (25.4, 1.2, 9.5)
    assert (first["latitude"], first["longitude"]) == (-12.54, -55.72)
    assert second["precipitation_mm"] is None  # shorter than time
    assert second["surface_pressure_hpa"] is None and second["rain_mm"] is None
    assert second["record_order"] > first["record_order"]


def test_payload_without_coordinates_or_hours(spark, tmp_path):
    _land(tmp_path, {"hourly": {"time": ["2026-08-15T00:00"]}}, name="a.json")
    _land(tmp_path, {"hourly": {"temperature_2m": [1.0]}}, name="b.json")
    _land(tmp_path, {"latitude": 1.0}, name="c.json")
    rows = _records(spark, tmp_path)
    assert len(rows) == 1
    assert (rows[0]["latitude"], rows[0]["longitude"]) == (-12.5, -55.7)


def test_statistics_rows_drop_the_header(spark, tmp_path):
    header = {"D1C": "code", "V": "figure"}
    row = {
        "D1C": "41", "D1N": "Paraná", "D2C": "216", "D2N": "Área colhida", "D3C": "2716", "D3N": "Trigo",
        "D4C": "2019", "D4N": "2019", "V": "1033.25", "MN": "Hectares",
    }
    (tmp_path / "a.json").write_text(json.dumps([header, row, {**row, "V": "..."}]))
    (tmp_path / "b.json").write_text("[]")
    records = statistics_records(read_statistics_rows(spark, str(tmp_path))).collect()
    assert len(records) == 2
    expected = {
        "territory_code": "41", "territory_name": "Paraná", "metric_code": "216", "metric_name": "Área colhida",
        "product_code": "2716", "product_name": "Trigo", "year": "2019", "unit": "Hectares", "source": "ibge_pam",
    }
    got = [r.asDict() for r in records]
    assert sorted(str(r.pop("value")) for r in got) == ["1033.25", "None"]
    assert sorted((r.pop("payload_file")[-6:], r.pop("payload_row")) for r in got) == [("a.json", 1), ("a.json", 2)]
    assert got[0] == got[1] == expected


def test_reference_data(spark, tmp_path):
    locations = read_locations(spark)
    assert locations.count() == 10
    assert dict(locations.dtypes)["latitude"] == "double"
    assert locations.where("city = 'Sorriso'").first()["latitude"] == -12.5425
    assert [r["product_name"] for r in read_products(spark).orderBy("product_code").collect()] == ["Soja", "Sorgo", "Tomate"]
    own = tmp_path / "products.csv"
    own.write_text("source,source_table,product_code,product_name,crop_type\nother,1,9,Uva,permanent\nibge_pam,1,8,Milho,temporary\n")
    assert [r["product_code"] for r in read_products(spark, str(own)).collect()] == ["8"]


def test_unreadable_payloads_are_told_from_readable_ones(spark, tmp_path):
    crops = tmp_path / "crops"
    crops.mkdir()
    broken = tmp_path / "weather" / "city=A" / "state=MT"
    broken.mkdir(parents=True)
    texts = {"a": '{"hourly": {"time": ["2026-08', "b": "", "c": "no json", "d": '{"latitude": 1.5}', "e": '{"latitude": "x", "hourly": {}}'}
    for name, text in texts.items():
        (broken / f"{name}.json").write_text(text)
    found = {r["payload_file"][-6]: r for r in read_weather_payloads(spark, str(tmp_path / "weather")).collect()}
    assert {name for name, r in found.items() if r["unreadable"] is not None} == {"a", "c", "e"}
    assert set(found) == set("acde") and landed_files(spark, str(tmp_path / "weather")).count() == 4  # the empty one waits
    assert found["a"]["unreadable"] == texts["a"] and found["d"]["latitude"] == 1.5
    assert all(r["city"] == "A" and r["state"] == "MT" and r["payload_size"] == len(texts[n]) for n, r in found.items())
    for name, text in {"a": '[{"D1C": ', "b": "[]", "c": '[{"D1C": "h"}, {"D1C": "41"}]', "d": "{}"}.items():
        (crops / f"{name}.json").write_text(text)
    arrays = {r["payload_file"][-6]: r["unreadable"] for r in read_statistics_payloads(spark, str(crops)).collect()}
    assert {name for name, text in arrays.items() if text is not None} == {"a", "d"}
    assert [r["D1C"] for r in read_statistics_rows(spark, str(crops)).collect()] == ["41"]
