"""Envelope JSON -> flat rows (golden pair), GeoJSON, snake_case."""

import json
import os

from roadloom.functions.naming import snake_case
from roadloom.operators.nested import flatten_contacts, metadata_row, to_snake_case
from roadloom.sources import read_customer_envelopes, read_geojson

RAW = {
    "data": [
        {"id": 7, "name": "Ada Park", "age": 41,
         "address": {"street": "9 Elm Rd", "city": "Springfield", "state": "OR", "zip": "97403"},
         "phoneNumbers": [{"type": "home", "number": "555-000-1111"}, {"type": "work", "number": "555-000-2222"}],
         "email": "ada@example.org", "isActive": True,
         "createdAt": "2023-03-04T05:06:07Z", "updatedAt": "2023-03-05T05:06:07Z"},
        {"id": 8, "name": "Bo Chen", "age": 30,
         "address": {"street": "1 Oak Ave", "city": "Salem", "state": "OR", "zip": "97301"},
         "phoneNumbers": [{"type": "work", "number": "555-000-3333"}],
         "email": "bo@example.org", "isActive": False,
         "createdAt": "2023-01-01T00:00:00Z", "updatedAt": "2023-01-02T00:00:00Z"},
    ],
    "metadata": {"totalCount": 2, "page": 1, "limit": 20, "generatedAt": "2023-03-06T00:00:00Z"},
}

EXPECTED = [
    {"user_id": 7, "name": "Ada Park", "age": 41, "address": "9 Elm Rd, Springfield OR 97403",
     "phone_home": "555-000-1111", "phone_work": "555-000-2222", "email": "ada@example.org", "is_active": True},
    {"user_id": 8, "name": "Bo Chen", "age": 30, "address": "1 Oak Ave, Salem OR 97301",
     "phone_home": None, "phone_work": "555-000-3333", "email": "bo@example.org", "is_active": False},
]

GEOJSON = {
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "properties": {"vehicleId": "V1", "name": "one", "speed": 40},
         "geometry": {"type": "Point", "coordinates": [2.15, 41.39]}},
        {"type": "Feature", "properties": {"vehicleId": "V2", "name": "two", "speed": 55},
         "geometry": {"type": "Point", "coordinates": [2.19, 41.41]}},
    ],
}


def _write(tmp_dir, name, obj):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        json.dump(obj, f, indent=2)
    return p


def test_envelope_golden_pair(spark, tmp_dir):
    _write(tmp_dir, "a.json", RAW)
    rows, meta = read_customer_envelopes(spark, tmp_dir)
    flat = flatten_contacts(rows)
    assert flat.columns == ["user_id", "name", "age", "address", "phone_home", "phone_work", "email",
                            "is_active", "created_at", "updated_at"]
    got = [{k: r[k] for k in EXPECTED[0]} for r in flat.orderBy("user_id").collect()]
    assert got == EXPECTED
    assert str(flat.orderBy("user_id").first()["created_at"]) == "2023-03-04 05:06:07"
    m = meta.first()
    assert m["totalCount"] == m["rows_in_file"] == 2


def test_corrupt_file_does_not_fail(spark, tmp_dir):
    _write(tmp_dir, "a.json", RAW)
    with open(os.path.join(tmp_dir, "b.json"), "w") as f:
        f.write("{not json")
    rows, _ = read_customer_envelopes(spark, tmp_dir)
    assert rows.count() == 2


def test_geojson_lon_lat_order(spark, tmp_dir):
    _write(tmp_dir, "g.json", GEOJSON)
    r = read_geojson(spark, tmp_dir).orderBy("vehicle_id").first()
    assert (r["vehicle_id"], r["longitude"], r["latitude"], r["speed"]) == ("V1", 2.15, 41.39, 40)


def test_snake_case():
    assert snake_case("isActive") == "is_active"
    assert snake_case("phoneNumbers") == "phone_numbers"
    assert snake_case("generatedAt") == "generated_at"
    assert snake_case("already_snake") == "already_snake"


def test_nested_struct_fields_renamed(spark, tmp_dir):
    _write(tmp_dir, "a.json", RAW)
    rows, meta = read_customer_envelopes(spark, tmp_dir)
    out = to_snake_case(meta.select("totalCount", "generatedAt"))
    assert out.columns == ["total_count", "generated_at"]
    assert "phone_numbers" in to_snake_case(rows).columns


def test_metadata_row(spark):
    df = spark.range(5)
    r = metadata_row(df, "2024-01-01 00:00:00").first()
    assert r["total_count"] == 5 and str(r["generated_at"]) == "2024-01-01 00:00:00"
