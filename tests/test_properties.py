"""Property tests: random inputs against plain-Python reference semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadloom.functions.gps import to_decimal_degrees
from roadloom.operators.incremental import key_set_changes, upsert
from roadloom.operators.sequence import ordered_sequence

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)

# (key, minute offset) rows; keys drawn from a tiny set so some keys are hot
rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=120)


@SETTINGS
@given(rows=rows_st, split=st.integers(2, 6), threshold=st.integers(1, 30))
def test_sequence_matches_python(spark, rows, split, threshold):
    data = [(i, k, T0 + dt.timedelta(minutes=m)) for i, (k, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k int, ts timestamp_ntz")
    got = ordered_sequence(df, ["k"], ["ts", "id"], row_number="rn", lags={"prev": "ts"},
                           max_group_rows=threshold, split=split)
    want = {}
    for k in {r[1] for r in data}:
        seq = sorted((r for r in data if r[1] == k), key=lambda r: (r[2], r[0]))
        for n, r in enumerate(seq):
            want[r[0]] = (n + 1, seq[n - 1][2] if n else None)
    assert {r["id"]: (r["rn"], r["prev"]) for r in got.collect()} == want


keys_st = st.sets(st.integers(0, 40), max_size=25)


@SETTINGS
@given(old=keys_st, new=keys_st)
def test_key_set_changes_matches_sets(spark, old, new):
    o = spark.createDataFrame([(k,) for k in old], "id int")
    n = spark.createDataFrame([(k,) for k in new], "id int")
    got = {(r["id"], r["change"]) for r in key_set_changes(o, n, ["id"]).collect()}
    assert got == {(k, "added") for k in new - old} | {(k, "removed") for k in old - new}


@SETTINGS
@given(existing=st.dictionaries(st.integers(0, 20), st.integers(0, 9), max_size=15),
       delta=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 9), st.integers(0, 100)), max_size=20))
def test_upsert_matches_dict(spark, existing, delta):
    ex = spark.createDataFrame([(k, v, T0) for k, v in existing.items()], "id int, v int, ts timestamp_ntz")
    dl = spark.createDataFrame([(k, v, T0 + dt.timedelta(minutes=m + 1)) for k, v, m in delta],
                               "id int, v int, ts timestamp_ntz")
    want = dict(existing)
    latest = {}
    for k, v, m in delta:
        if k not in latest or (m, v) > latest[k]:
            latest[k] = (m, v)
    want.update({k: v for k, (m, v) in latest.items()})
    got = {r["id"]: r["v"] for r in upsert(ex, dl, ["id"], ts_col="ts").collect()}
    assert got == want


coord = st.tuples(st.integers(0, 89), st.integers(0, 59), st.integers(0, 59), st.integers(0, 999),
                  st.integers(0, 179), st.integers(0, 59), st.integers(0, 59), st.integers(0, 999),
                  st.sampled_from("NS"), st.sampled_from("EW"))


@SETTINGS
@given(cs=st.lists(coord, min_size=1, max_size=10))
def test_gps_notations_round_trip(spark, cs):
    texts, want = [], []
    for la, lam, las, laf, lo, lom, los, lof, h1, h2 in cs:
        s1 = (-1 if h1 == "S" else 1)
        s2 = (-1 if h2 == "W" else 1)
        lat = la + lam / 60 + (las + laf / 1000) / 3600
        lon = lo + lom / 60 + (los + lof / 1000) / 3600
        texts.append(f"{la}°{lam}'{las}.{laf:03d}\"{h1}, {lo}°{lom}'{los}.{lof:03d}\"{h2}")
        want.append((s1 * lat, s2 * lon))
        texts.append(f"{la}.{laf:03d} {h1}, {lo}.{lof:03d} {h2}")
        want.append((s1 * float(f"{la}.{laf:03d}"), s2 * float(f"{lo}.{lof:03d}")))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, g string")
    got = {r["i"]: r["p"] for r in df.select("i", to_decimal_degrees("g").alias("p")).collect()}
    for i, (lat, lon) in enumerate(want):
        assert abs(got[i]["latitude"] - lat) < 1e-9 and abs(got[i]["longitude"] - lon) < 1e-9
