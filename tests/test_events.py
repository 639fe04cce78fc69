"""Event operators on edge cases: NULL keys, duplicate times, strategies agree."""

import datetime as dt

from pyspark.sql import functions as F

from roadloom.operators import events
from roadloom.operators.events import event_rollup, monthly_event_profile, net_purchases
from roadloom.plans.checks import executed_plan
from tests.conftest import SF_MID, SF_SMALL

T0 = dt.datetime(2024, 1, 31, 23, 0)


def _edge_events(spark):
    rows = [
        (1, "a", T0, 1.25), (1, "a", T0, 2.5),                    # same (user, type, time) twice
        (1, "b", T0, 4.0),                                        # same time, other type
        (1, "a", T0 + dt.timedelta(hours=2), 8.0),                # next month, next day
        (2, "a", T0, None),                                       # NULL amount
        (None, "a", T0 + dt.timedelta(days=40), 16.0),            # NULL user
        (3, None, T0 + dt.timedelta(days=400), 32.0),             # NULL type, next year
        (3, "c", None, 64.0),                                     # NULL time
    ]
    return spark.createDataFrame(rows, "user_id int, event_type string, event_date timestamp_ntz, event_amount double")


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_staged_rollup_equals_expand(spark):
    ev = _edge_events(spark)
    staged = event_rollup(ev, float_scale=6)
    expand = event_rollup(ev, float_scale=6, strategy="expand")
    assert _rows(staged) == _rows(expand)
    assert "Expand" not in executed_plan(staged)


def test_staged_rollup_on_table(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    kw = dict(user="user_id", ts="ts", event_type="event_type", amount="value", float_scale=6)
    assert _rows(event_rollup(ev, **kw)) == _rows(event_rollup(ev, strategy="expand", **kw))


def test_net_purchases_counts(spark):
    ev = _edge_events(spark)
    got = {r["user_id"]: r for r in net_purchases(ev, purchase="a", refund="b").collect()}
    assert got[1]["net_purchases"] == 1.25 + 2.5 + 8.0 - 4.0
    assert (got[1]["total_purchases"], got[1]["total_refunds"]) == (3, 1)


def test_profile_gap_crosses_month_and_belongs_to_later_event(spark):
    ev = _edge_events(spark).where(F.col("user_id") == 1).withColumn("event_id", F.monotonically_increasing_id())
    prof = monthly_event_profile(ev, vehicle="user_id", ts="event_date", tiebreak="event_id",
                                 event_type="event_type", location="event_type", maintenance="b")
    got = {(r["event_year"], r["event_month"]): r for r in prof.collect()}
    jan, feb = got[(2024, 1)], got[(2024, 2)]
    assert (jan["total_events"], jan["maintenance_events"], jan["unique_locations"]) == (3, 1, 2)
    assert jan["avg_time_between_events"] == 0.0      # three events at the same instant
    assert feb["avg_time_between_events"] == 7200.0   # gap from January's last event


def test_rollup_states_merge_within_the_stated_error(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    names = {"user": "user_id", "ts": "ts", "event_type": "event_type", "amount": "value"}
    cut = F.col("event_id") % 3
    # every third event is in two of the states: sketches see its time once
    merged = events.rollup_merged(*[events.rollup_state(ev.where((cut == k) | (cut == 2)), **names) for k in range(2)])
    exact = {(r.grain, r.user, r.month, r.type): r.times for r in events.rollup_state(ev, **names).collect()}
    got = {(r.grain, r.user, r.month, r.type): r.times for r in merged.collect()}
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - n) <= max(1, 0.06 * n) for k, n in exact.items())
    whole = {(r.user_id, r.month, r.event_type, r.grouping_id): r.distinct_event_dates
             for r in events.event_rollup(ev, **names).collect()}
    state = events.rollup_rows(events.rollup_state(ev, **names))
    assert {(r.user_id, r.month, r.event_type, r.grouping_id): r.distinct_event_dates for r in state.collect()} == whole


def test_rollup_delta_with_late_and_null_rows(spark):
    schema = "user_id int, event_date timestamp_ntz, event_type string, event_amount double"
    t = lambda s: dt.datetime.fromisoformat(s)
    old = [(1, t("2024-01-05"), "a", 1.0), (1, t("2024-02-05"), "a", 2.0), (2, t("2024-01-05"), "b", 4.0), (None, t("2024-01-07"), None, 8.0)]
    new = [(1, t("2024-01-05"), "b", 16.0), (3, t("2024-03-01"), "a", None), (None, None, "a", 32.0)]
    a, b = (spark.createDataFrame(x, schema) for x in (old, new))
    state = events.rollup_extended(events.rollup_state(a), a.unionByName(b), b)
    want = events.event_rollup(a.unionByName(b))
    assert sorted(map(tuple, events.rollup_rows(state).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
