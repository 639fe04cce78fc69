"""The connected JSON run: every input row ends up in a table or in rejects with a reason."""

import json
import os

import pytest

from roadloom.plans.pipelines import run_json_pipeline
from roadloom.sinks import audit_change
from roadloom.sources.documents import read_geojson, read_geojson_checked
from tests.test_nested import GEOJSON, RAW


def put(folder, **files):
    os.makedirs(folder)
    for name, content in files.items():
        with open(os.path.join(folder, name + ".json"), "w") as f:
            f.write(content if isinstance(content, str) else json.dumps(content))


def track(gps, vehicle="A", time="2022-01-01T12:00:00Z", distance=10.0, **more):
    return {"gps_coordinates": gps, "vehicle_id": vehicle, "time_stamp": time, "distance_traveled": distance, **more}


def test_every_row_is_loaded_or_rejected(spark, tmp_dir):
    people = dict(RAW, data=[*RAW["data"], {"name": "no id"}, {"id": "seven"}, "text", {"id": 9, "age": "old"}])
    put(f"{tmp_dir}/people", a=people, b="{broken", c=[1, 2], d={"data": []})
    put(f"{tmp_dir}/tracks", a={"data": [
        track("41.38,2.17"), track("41.38 N, 2.17 E", distance=5), track("41°23'00.0\"N, 2°10'00.0\"E", "B"), track("41.38,2.17", time="2021-05-05T00:00:00Z"),
        track("nowhere"), track("95.5,2.17"), track("48.85,2.15"), track(None), track("41.38,2.17", time="no time"), track("41.38,2.17", distance="far"), 5]},
        b="nope")
    out = f"{tmp_dir}/out"
    report = run_json_pipeline(spark, f"{tmp_dir}/people", f"{tmp_dir}/tracks", out)
    c, t = report["customers"], report["tracks"]
    assert (c["rows"], c["rejected_document"], c["rejected_record"]) == (2, 2, 4)
    assert (t["rows"], t["rejected_document"], t["rejected_track"], t["rejected_position"], t["rejected_time"]) == (5, 1, 3, 3, 1)
    assert c["table"]["rows_written"] == c["table"]["rows_after"] == 2 and t["table"]["rows_written"] == 3
    got = {(r.vehicle_id, r.year): round(r.distance_traveled, 6) for r in spark.read.parquet(f"{out}/tables/vehicle_distance").collect()}
    assert got == {("A", 2022): 9.320565, ("A", 2021): 6.21371, ("B", 2022): 6.21371}
    reasons = sorted(r.reason for r in spark.read.json(f"{out}/rejects/customers").collect())
    assert reasons == ["bad_type:age", "bad_type:id", "missing:id", "no_data", "not_an_object", "not_json"]
    reasons = sorted(r.reason for r in spark.read.json(f"{out}/rejects/tracks").collect())
    assert reasons == ["bad_format", "bad_type:distance_traveled", "fence", "missing:gps_coordinates", "not_an_object", "not_json", "out_of_range"]
    again = run_json_pipeline(spark, f"{tmp_dir}/people", f"{tmp_dir}/tracks", out)  # a second append is audited too
    assert again["customers"]["table"]["rows_before"] == 2 and again["customers"]["table"]["rows_after"] == 4


def test_audit_sees_lost_rows():
    assert audit_change(3, 5, {"rows_written": 2})["rows_after"] == 5
    with pytest.raises(ValueError):
        audit_change(3, 4, {"rows_written": 2})


def test_geojson_keeps_unknown_properties_and_rejects_the_rest(spark, tmp_dir):
    more = json.loads(json.dumps(GEOJSON))
    more["features"][0]["properties"] |= {"battery": 80, "tags": ["x", {"y": 1}]}
    bad = {"features": [{"properties": {"vehicleId": "V3"}}, {"properties": {"name": "n"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, 7,
                        {"properties": {"vehicleId": "V4", "speed": "fast"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
                        {"properties": {"vehicleId": "V5"}, "geometry": {"type": "LineString", "coordinates": [1, 2]}},
                        {"properties": {"vehicleId": "V6"}, "geometry": {"type": "Point", "coordinates": [1]}}]}
    put(f"{tmp_dir}/geo", a=more, b=bad, c="{", d={"type": "FeatureCollection"})
    rows, rejects = read_geojson_checked(spark, f"{tmp_dir}/geo")
    got = {r.vehicle_id: r for r in rows.collect()}
    assert set(got) == {"V1", "V2"} and got["V1"].other_properties == {"battery": "80", "tags": '["x",{"y":1}]'} and got["V2"].other_properties == {}
    assert sorted(r.reason for r in rejects.collect()) == ["bad_type:speed", "missing:coordinates", "missing:vehicle_id", "no_features", "no_position",
                                                           "not_a_point", "not_an_object", "not_json"]
    put(f"{tmp_dir}/fine", a=GEOJSON)
    plain = sorted(map(tuple, read_geojson(spark, f"{tmp_dir}/fine").collect()))
    assert sorted(tuple(r)[:-1] for r in read_geojson_checked(spark, f"{tmp_dir}/fine")[0].collect()) == plain
