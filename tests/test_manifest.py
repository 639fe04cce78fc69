"""Copy-on-write snapshots: untouched folders stay, readers see whole states, one of two writers loses."""

import os

import pytest
from pyspark.sql import functions as F

from roadloom.sinks import manifest
from roadloom.sinks.manifest import Conflict, bucket_of, current, expire, fingerprints, merge, replace

SCHEMA = "id long, name string, v double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def folders(base):
    return {p: x.folder for p, x in base.parts.items()}


def files(base, snap):
    return {p: sorted(os.listdir(f"{base}/data/{x.folder}")) for p, x in snap.parts.items()}


def upsert(stored, delta):
    if stored is None:
        return delta
    kept = stored.join(delta.select(F.col("id").alias("k")), F.col("id").eqNullSafe(F.col("k")), "left_anti")
    return kept.unionByName(delta)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_touched_partitions_are_written(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    part = bucket_of(["id"], 8)
    rows = [(i, f"n{i}", float(i)) for i in range(200)] + [(None, None, None)]
    assert replace(spark, base, frame(spark, *rows), part)["version"] == 1
    one = current(spark, base)
    before = files(base, one)
    assert content(one.read()) == content(frame(spark, *rows)) and one.rows == 201
    done = merge(spark, base, frame(spark, (7, "new", 1.0), (1000, "added", 2.0)), part, upsert)
    two = current(spark, base)
    changed = {p for p in two.parts if folders(one).get(p) != folders(two)[p]}
    assert changed == set(done["written"]) and 1 <= len(changed) <= 2 and done["kept"] == len(two.parts) - len(changed)
    assert {p: f for p, f in files(base, two).items() if p not in changed} == {p: f for p, f in before.items() if p not in changed}
    want = [r for r in rows if r[0] != 7] + [(7, "new", 1.0), (1000, "added", 2.0)]
    assert content(two.read()) == content(frame(spark, *want))
    # the earlier state is still whole
    assert content(manifest.snapshot(spark, base, 1).read()) == content(frame(spark, *rows))


def test_a_rerun_publishes_nothing_and_a_duplicate_counts(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    part = bucket_of(["id"], 4)
    rows = [(1, "a", 1.0), (2, "b", None)]
    replace(spark, base, frame(spark, *rows), part)
    again = replace(spark, base, frame(spark, *reversed(rows)), part, parent=current(spark, base))
    assert not again["changed"] and len(os.listdir(f"{base}/data")) == 1
    assert not merge(spark, base, frame(spark, rows[0]), part, upsert)["changed"]
    twice = replace(spark, base, frame(spark, *rows, rows[0]), part, parent=current(spark, base))
    assert twice["changed"] and current(spark, base).rows == 3


def test_the_change_test_reads_no_stored_row(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    replace(spark, base, frame(spark, (1, "a", 1.0), (2, "b", 2.0)), F.lit("p"))
    snap = current(spark, base)
    for name in os.listdir(f"{base}/data/{snap.parts['p'].folder}"):
        os.remove(f"{base}/data/{snap.parts['p'].folder}/{name}")
    assert not replace(spark, base, frame(spark, (2, "b", 2.0), (1, "a", 1.0)), F.lit("p"), parent=snap)["changed"]


def test_fingerprints_see_places_and_nulls(spark):
    def of(*rows, schema="a string, b string, c array<int>"):
        return fingerprints(spark.createDataFrame(list(rows), schema), F.lit("p")).collect()

    assert of(("x", None, None)) != of((None, "x", None))
    assert of((None, None, [1, None])) != of((None, None, [None, 1])) != of((None, None, [1]))
    assert of(("a", "b", None), ("c", "d", [2])) == of(("c", "d", [2]), ("a", "b", None))
    assert of(("a", "b", None)) != of(("a", "b", None), ("a", "b", None))


def test_a_reader_between_any_two_steps_sees_a_whole_snapshot(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "s")
    part = bucket_of(["id"], 4)
    old = [(i, "old", 1.0) for i in range(20)]
    new = [(i, "new", 2.0) for i in range(20)]
    replace(spark, base, frame(spark, *old), part)
    seen = []

    def look(name):
        real = getattr(manifest, name)

        def step(*args, **kwargs):
            seen.append(content(current(spark, base).read()))
            out = real(*args, **kwargs)
            seen.append(content(current(spark, base).read()))
            return out

        monkeypatch.setattr(manifest, name, step)

    for name in ("fingerprints", "_drop", "_publish"):
        look(name)
    replace(spark, base, frame(spark, *new), part, parent=current(spark, base))
    assert len(seen) >= 6 and all(s in (content(frame(spark, *old)), content(frame(spark, *new))) for s in seen)
    assert seen[0] == content(frame(spark, *old)) and seen[-1] == content(frame(spark, *new))


def test_a_write_that_fails_leaves_the_old_snapshot(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    replace(spark, base, frame(spark, (1, "a", 1.0)), F.lit("p"))
    broken = frame(spark, (2, "b", 2.0)).withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        replace(spark, base, broken, F.lit("p"), parent=current(spark, base))
    assert content(current(spark, base).read()) == [(1, "a", 1.0)]


def test_two_writers_cannot_both_win(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    part = bucket_of(["id"], 4)
    replace(spark, base, frame(spark, (1, "a", 1.0)), part)
    first = second = current(spark, base)
    replace(spark, base, frame(spark, (1, "first", 1.0)), part, parent=first)
    with pytest.raises(Conflict):
        replace(spark, base, frame(spark, (1, "second", 1.0)), part, parent=second)
    assert content(current(spark, base).read()) == [(1, "first", 1.0)]
    # a merge starts again from what the other one published
    calls = []

    def slow(stored, delta):
        if not calls:
            merge(spark, base, frame(spark, (5, "other", 5.0)), part, upsert)
        calls.append(1)
        return upsert(stored, delta)

    merge(spark, base, frame(spark, (6, "mine", 6.0)), part, slow)
    assert len(calls) == 2
    assert content(current(spark, base).read()) == [(1, "first", 1.0), (5, "other", 5.0), (6, "mine", 6.0)]


def test_emptied_null_and_odd_partitions(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    part = F.col("name")
    replace(spark, base, frame(spark, (1, "x", 1.0), (2, None, 2.0), (3, "y", 3.0)), part)
    assert set(current(spark, base).parts) == {"x", "y", "null"}
    done = replace(spark, base, frame(spark, (4, "y", 4.0)), part, parts={"x", "y"}, parent=current(spark, base))
    assert done["changed"] and content(current(spark, base).read()) == [(2, None, 2.0), (4, "y", 4.0)]
    with pytest.raises(ValueError, match="not replaced"):
        replace(spark, base, frame(spark, (4, "z", 4.0)), part, parts={"y"}, parent=current(spark, base))
    with pytest.raises(Exception, match="no name"):
        replace(spark, base, frame(spark, (4, "a/b", 4.0)), part, parent=current(spark, base))
    replace(spark, base, frame(spark), part, parent=current(spark, base))
    assert current(spark, base).read().collect() == [] and current(spark, base).read().columns == ["id", "name", "v"]


def test_expire_keeps_what_is_named(spark, tmp_dir):
    base = os.path.join(tmp_dir, "s")
    part = bucket_of(["id"], 4)
    for v in range(4):
        replace(spark, base, frame(spark, (1, f"v{v}", 1.0), (2, "same", 1.0)), part, parent=current(spark, base))
    want = content(current(spark, base).read())
    assert expire(spark, base, keep=1) == 3
    assert content(current(spark, base).read()) == want == [(1, "v3", 1.0), (2, "same", 1.0)]
    assert expire(spark, base, keep=1) == 0
