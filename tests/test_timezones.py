"""Results do not depend on the session time zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadloom.functions.columns import instant_to_utc_ntz, micros_between, month_start, parse_iso_utc, year_start
from roadloom.operators.events import event_rollup, monthly_event_profile
from tests.conftest import SF_SMALL


@pytest.fixture()
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_parsing_and_truncation_are_zone_free(spark, new_york):
    df = spark.createDataFrame([("2022-03-13T06:30:00Z", dt.datetime(2022, 3, 13, 1, 30))],
                               "s string, t timestamp_ntz")
    r = df.select(parse_iso_utc("s").alias("p"), month_start("t").alias("m"), year_start("t").alias("y"),
                  micros_between(F.col("t"), F.col("t") + F.expr("INTERVAL 2 HOURS"), ntz=True).alias("d"),
                  instant_to_utc_ntz(F.to_timestamp(F.lit("2022-11-06 05:30:00Z"), "yyyy-MM-dd HH:mm:ssX")).alias("i")
                  ).first()
    assert r["p"] == dt.datetime(2022, 3, 13, 6, 30)
    assert (r["m"], r["y"]) == (dt.datetime(2022, 3, 1), dt.datetime(2022, 1, 1))
    assert r["d"] == 2 * 3600 * 1_000_000          # across the DST change in New York
    assert r["i"] == dt.datetime(2022, 11, 6, 5, 30)


def test_operators_same_in_any_zone(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    kw = dict(user="user_id", ts="ts", event_type="event_type", amount="value", float_scale=6)
    prof = dict(vehicle="user_id", ts="ts", tiebreak="event_id", event_type="event_type",
                location="event_type", maintenance="error")
    utc = (_rows(event_rollup(ev, **kw)), _rows(monthly_event_profile(ev, **prof)))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = (_rows(event_rollup(ev, **kw)), _rows(monthly_event_profile(ev, **prof)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other


def test_every_contract_query_is_zone_free(spark):
    import __spark_entry__ as entry

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name, fn in sorted(entry.queries().items()):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            utc = _rows(fn(spark, SF_SMALL))
            spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
            la = _rows(fn(spark, SF_SMALL))
            assert utc == la, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
