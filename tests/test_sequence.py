"""The hot-key split gives exactly the plain window's row numbers and lags."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadloom.operators.sequence import ordered_sequence, segment_bounds
from tests.conftest import SF_MID


def _skewed_events(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    # a third of all rows move to user 0: one very hot key
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _plain(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).withColumn("prev", F.lag("ts", 1).over(w))


def test_split_equals_plain_window(spark):
    ev = _skewed_events(spark).select("event_id", "user_id", "ts", "event_type")
    expect = _plain(ev, ["user_id"], ["ts", "event_id"])
    got = ordered_sequence(ev, ["user_id"], ["ts", "event_id"], row_number="rn",
                           lags={"prev": "ts"}, max_group_rows=200, split=8)
    cols = ["event_id", "user_id", "ts", "rn", "prev"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, expect.select(cols).collect()))


def test_split_with_two_keys_and_ties(spark):
    ev = _skewed_events(spark).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    ev = ev.select("event_id", "user_id", "event_type", "ts")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    expect = _plain(ev, keys, order)
    got = ordered_sequence(ev, keys, order, row_number="rn", lags={"prev": "ts"}, max_group_rows=50, split=16)
    cols = ["event_id", "rn", "prev"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, expect.select(cols).collect()))


def test_hot_key_is_split_across_tasks(spark):
    ev = _skewed_events(spark).select("event_id", "user_id", "ts")
    got = ordered_sequence(ev, ["user_id"], ["ts", "event_id"], row_number="rn",
                           max_group_rows=200, split=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__rl_bucket" in plan
    assert got.where("user_id = 0").agg(F.max("rn")).first()[0] == ev.where("user_id = 0").count()


def test_no_split_mode(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "user_id", "ts")
    a = ordered_sequence(ev, ["user_id"], ["ts", "event_id"], row_number="rn", max_group_rows=None)
    b = _plain(ev, ["user_id"], ["ts", "event_id"])
    assert sorted(map(tuple, a.select("event_id", "rn").collect())) == sorted(
        map(tuple, b.select("event_id", "rn").collect()))


def _check(spark, df, keys, order, split):
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    want = df.withColumn("rn", F.row_number().over(w).cast("long")).withColumn("prev", F.lag("v", 1).over(w))
    got = ordered_sequence(df, keys, order, row_number="rn", lags={"prev": "v"}, split=split)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_one_time_value_nulls_and_few_rows(spark):
    schema = "k string, t int, i int, v string"
    same = [("hot", 5, i, f"v{i}") for i in range(400)]
    mixed = [(["a", "b", None][i % 3], None if i % 4 == 0 else i % 7, i, None if i % 5 == 0 else f"v{i}") for i in range(300)]
    for rows in (same, mixed, same + mixed, mixed[:1], mixed[:5], []):
        for split in (2, 7, 64):
            _check(spark, spark.createDataFrame(rows, schema).repartition(3), ["k"], ["t", "i"], split)


def test_a_key_with_one_time_value_is_split(spark):
    df = spark.createDataFrame([("hot", 5, i) for i in range(4000)], "k string, t int, i int")
    bounds = segment_bounds(df, ["k"], ["t", "i"], 8).first()["b"]
    cuts = [b.o.o1 for b in bounds]
    assert cuts == sorted(cuts) and max(b - a for a, b in zip([0, *cuts], [*cuts, 4000])) < 1000


def test_building_the_frame_starts_no_job(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    spark.sparkContext.setJobGroup("sequence-build", "none expected")
    try:
        ordered_sequence(ev, ["user_id"], ["ts", "event_id"], lags={"p": "ts"})
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("sequence-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_carry_no_bounds(spark):
    """A row meets the bounds of its own key in a broadcast join; no array of all bounds goes through every row."""
    df = spark.createDataFrame([(k, 5, i, "v") for k in ("hot", "x", None) for i in range(200)], "k string, t int, i int, v string")
    got = ordered_sequence(df, ["k"], ["t", "i"], row_number="rn", lags={"prev": "v"}, split=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "subquery" not in plan.lower() and plan.count("BroadcastHashJoin") >= 3
    assert got.agg(F.max("rn")).first()[0] == 200
