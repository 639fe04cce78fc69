"""End-to-end loads: the reference's entry points as Spark jobs.

* ``delta_load``: the ``*_delta`` methods (test for change, merge, publish).
  Snapshots are manifests (`sinks.manifest`): only partitions that hold a key
  of the delta are read and written, and whether anything changed is told by
  fingerprints of the new rows.
* ``trips_delta``: new route points and trip facts, in the order they arrive,
  merged into one state per trip; the summary is a view of the states.
* ``run_json_pipeline``: the JSON pipeline as one connected run (raw documents
  -> intermediate JSON lines -> two tables, rejects with reasons, audits);
  ``json_ingestion`` and ``run_etl`` are its steps on their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.functions.columns import parse_iso_utc
from roadloom.operators import geo, gps, incremental, nested, trips
from roadloom.operators.events import dedupe_latest
from roadloom.sinks import append_table, audit_change, manifest, rows_of, write_json_lines, write_versioned
from roadloom.sources import read_customer_envelopes, read_geojson, read_json_lines
from roadloom.sources.documents import REJECT, read_envelopes_checked, read_tracks_checked
from roadloom.sources.schemas import VEHICLE_TRACK


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delta_load(
    spark: SparkSession,
    snapshot_base: str,
    source: DataFrame,
    keys: list[str],
    ts_col: str,
    *,
    mode: str = "upsert",
    change_test: str = "watermark",
    buckets: int = manifest.BUCKETS,
) -> dict:
    """Publish ``source`` merged into the current snapshot if it changed.

    The snapshot is bucketed by ``keys``.  ``change_test``: ``rows`` (any row of any partition differs, duplicates
    included; told by fingerprints without reading a stored row), or the tests of the source scripts, which may
    skip a changed source: ``watermark`` (newest timestamp differs), ``key_set``, ``key_count``; ``always`` leaves it to the
    fingerprints too.  ``mode``: ``refresh`` (the source is the whole new state) or ``upsert`` (a window of
    changes, see ``incremental.upsert``).  Partitions whose rows stay the same keep their folders.  Returns what happened.
    """
    if mode not in ("refresh", "upsert"):
        raise ValueError("mode must be 'refresh' or 'upsert'")
    part = manifest.bucket_of(keys, buckets)
    stored = manifest.current(spark, snapshot_base)
    if stored is not None:
        if change_test == "watermark":
            changed = incremental.watermark_changed(stored.read(), source, ts_col)
        elif change_test == "key_set":
            changed = not incremental.key_sets_equal(stored.read(), source, keys)
        elif change_test == "key_count":
            changed = incremental.key_count_changed(stored.read(), source, keys[0])
        elif change_test in ("always", "rows"):
            changed = True
        else:
            raise ValueError(f"unknown change_test {change_test!r}")
        if not changed:
            return {"changed": False, "initial": False, "version": None}
    if mode == "refresh":
        return manifest.replace(spark, snapshot_base, source, part, parent=stored) | {"initial": stored is None}

    def combine(old: DataFrame | None, delta: DataFrame) -> DataFrame:
        if old is None:
            return dedupe_latest(delta, keys, ts=ts_col).select(*delta.columns)
        return incremental.upsert(old, delta, keys, ts_col=ts_col, small=incremental.is_small(delta, keys))

    return manifest.merge(spark, snapshot_base, source, part, combine)


def refresh_if_changed(
    spark: SparkSession,
    snapshot_base: str,
    source: DataFrame,
    ts_col: str,
    build,
) -> dict:
    """Publish ``build(source)`` when the source's newest ``ts_col`` moved.

    For outputs that are aggregates (booking statistics, monthly profiles):
    the change test runs on the source rows (the output has no timestamp),
    and the mark is stored next to the snapshot.  The mark is written after
    the new version, so a crash in between only republishes the same result.
    """
    mark_path = f"{snapshot_base.rstrip('/')}/_MARK"
    mark = incremental.high_watermark(source, ts_col)
    mark_text = "" if mark is None else str(mark)
    if _exists(spark, mark_path) and spark.read.text(mark_path).first()["value"] == mark_text:
        return {"changed": False, "version": None, "mark": mark_text}
    version = write_versioned(build(source), snapshot_base)
    spark.createDataFrame([(mark_text,)], "value string").coalesce(1).write.mode("overwrite").text(mark_path)
    return {"changed": True, "version": version, "mark": mark_text}


#: Prefix of the partitions of trips whose points or facts are still missing.
WAITING = "waiting-"


def trips_view(rows: DataFrame, *, trip: str, names: dict[str, str]) -> DataFrame:
    """What readers of a trips snapshot get: the summary rows under the snapshot's column names."""
    out = trips.state_rows(rows, trip=trip)
    return out.withColumnsRenamed(names) if names else out


manifest.VIEWS["trips"] = trips_view


def trips_delta(
    spark: SparkSession,
    snapshot_base: str,
    points: DataFrame,
    trip_facts: DataFrame,
    *,
    trip: str = "vehicle_trip_id",
    trips_key: str = "id",
    ts: str = "created_on",
    tiebreak: str | None = None,
    columns: list[str] | None = None,
    version: str | None = None,
    points_since: str | None = None,
    facts_since: str | None = None,
    lateness: dt.timedelta = dt.timedelta(0),
    names: dict[str, str] | None = None,
    buckets: int = manifest.BUCKETS,
) -> dict:
    """Trip summaries kept up to date with points and facts as they arrive.

    Published is one state per trip (`trips.trip_state`); readers see `trips.state_rows` of it.  The states that the new rows
    touch are merged, whatever the new rows' event times: an earlier point moves a trip's start, facts
    that come after the points complete the trip, changed facts replace the old ones, and a rerun changes nothing.

    ``points_since`` and ``facts_since`` name the columns that tell when a row arrived; then only rows from the
    stored mark less ``lateness`` on are read, and the marks are published together with the rows.  Facts of trips that wait for
    theirs are read whatever their time.  Without the columns everything given is taken in, as for the files of one
    arrival.  ``names`` maps columns of the summary to those that readers see.
    """
    stored = manifest.current(spark, snapshot_base)
    marks = stored.properties if stored else {}
    properties = manifest.view_property("trips", trip=trip, names=names or {})

    def news(df: DataFrame, column: str | None, name: str) -> DataFrame:
        if not column:
            return df
        since = marks.get(name)
        newest = df.agg(F.max(column).cast("string")).first()[0]
        if newest is not None:
            properties[name] = newest
        elif since:
            properties[name] = since
        if not since:
            return df
        kind = df.schema[column].dataType
        from_ = F.lit(since).cast(kind)
        return df.where(F.col(column) >= (from_ - F.lit(lateness) if lateness else from_))

    arrived = news(trip_facts, facts_since, "facts_mark")
    waiting = {p for p in stored.parts if p.startswith(WAITING)} if stored else set()
    if facts_since and waiting:
        missing = trips.trips_pending(stored.read(waiting), trip).select(F.col(trip).alias("__rl_w"))
        arrived = arrived.unionByName(trip_facts.join(missing, F.col(trips_key) == F.col("__rl_w"), "left_semi"))
    delta = trips.trip_state(news(points, points_since, "points_mark"), arrived, trip=trip, trips_key=trips_key, ts=ts, tiebreak=tiebreak,
                             columns=columns, version=version)
    bucket = manifest.bucket_of([trip], buckets)
    whole = F.col("first_point").isNotNull() & F.col("facts").isNotNull()
    return manifest.merge(
        spark, snapshot_base, delta, bucket, lambda old, new: new if old is None else trips.merge_states(old, new, trip=trip),
        twins=lambda p: {p, WAITING + p}, result_part=F.when(whole, bucket).otherwise(F.concat(F.lit(WAITING), bucket)), properties=properties)


def json_ingestion(spark: SparkSession, customers_path: str, vehicles_path: str, out_dir: str,
                   box: dict[str, float] | None = None, mode: str = "inside") -> dict:
    """Raw envelopes and GeoJSON -> cleaned, flat JSON lines (the ingestion step)."""
    rows, _ = read_customer_envelopes(spark, customers_path)
    customers = nested.flatten_contacts(rows).na.drop("any", subset=["user_id"])
    vehicles = geo.geo_fence(read_geojson(spark, vehicles_path), box=box, mode=mode, drop_nulls="coords")
    write_json_lines(customers, f"{out_dir.rstrip('/')}/customers")
    write_json_lines(vehicles, f"{out_dir.rstrip('/')}/vehicles")
    return {"customers": f"{out_dir.rstrip('/')}/customers", "vehicles": f"{out_dir.rstrip('/')}/vehicles"}


def run_etl(spark: SparkSession, tracks_path: str, target: str, rejects: str) -> dict:
    """Tracks (JSON lines) -> fleet pipeline -> appended table with rejects, audited."""
    tracks = read_json_lines(spark, tracks_path, VEHICLE_TRACK)
    bad = append_table([trips.fleet_rejects(tracks)], f"{rejects.rstrip('/')}/positions")
    stats = append_audited(spark, trips.run_fleet_pipeline(tracks), target, ["vehicle_id", "year"], f"{rejects.rstrip('/')}/rows")
    return {"rows_written": stats["rows_written"], "rows_rejected": stats["rows_rejected"] + bad["rows_written"]}


def append_audited(spark: SparkSession, df: DataFrame, target: str, required: list[str], rejects: str) -> dict:
    """`append_table`, with the target's rows before and after held against the rows that it reports."""
    before = rows_of(spark, target)
    stats = append_table([df], target, required=required, rejects=rejects)
    return audit_change(before, rows_of(spark, target), stats)


def _stage(spark: SparkSession, rows: DataFrame, rejects: list[DataFrame], path: str, rejects_path: str) -> dict[str, int]:
    """Write an intermediate stage and its rejects; counts of both."""
    write_json_lines(rows, path)
    union = rejects[0]
    for r in rejects[1:]:
        union = union.unionByName(r)
    union.write.mode("overwrite").json(rejects_path)
    levels = {r["level"]: r["n"] for r in spark.read.schema(REJECT).json(rejects_path).groupBy("level").agg(F.count("*").alias("n")).collect()}
    return {"rows": spark.read.schema(rows.schema).json(path).count(), **{f"rejected_{k}": v for k, v in sorted(levels.items())}}


def run_json_pipeline(spark: SparkSession, customers_path: str, tracks_path: str, out: str, *, box: dict[str, float] | None = None,
                      mode: str = "inside", unit: str = "mile") -> dict:
    """Both raw sources -> intermediate JSON lines -> two tables, in one connected run.

    ``customers_path`` and ``tracks_path`` hold ``{data: [...]}`` documents.  Ingestion rejects documents that are no JSON
    and records with missing values or other types; of tracks it converts the position to decimal degrees and rejects those in
    no accepted notation, out of range or on the wrong side of the fence.  The intermediate files are what the next step reads.
    Customers are loaded flat, tracks as distance per vehicle and year.  Each table's rows before and after are
    audited.  Nothing is dropped without a row under ``out``/rejects that says why.  Returns the counts of each step.
    """
    base = out.rstrip("/")
    records, bad_customers = read_envelopes_checked(spark, customers_path)
    customers = nested.flatten_contacts(records)
    tracks, bad_tracks = read_tracks_checked(spark, tracks_path)
    placed = gps.once_per_row(gps.normalize_gps(tracks, "gps_coordinates"), "gps_reason")
    fenced = placed.withColumn("reason", F.when(F.col("gps_reason") != gps.ACCEPTED, F.col("gps_reason")).when(
        geo.fence_predicate("latitude", "longitude", box or geo.BARCELONA_BOX) != F.lit(mode == "inside"), F.lit("fence")))
    off = fenced.where("reason IS NOT NULL").select(F.lit(None).cast("string").alias("file"), F.lit("position").alias("level"), "reason",
                                                    F.to_json(F.struct(*tracks.columns)).alias("content"))
    kept = fenced.where("reason IS NULL").select(*tracks.columns, "latitude", "longitude")
    report = {
        "customers": _stage(spark, customers, [bad_customers], f"{base}/intermediate/customers", f"{base}/rejects/customers"),
        "tracks": _stage(spark, kept, [bad_tracks, off], f"{base}/intermediate/tracks", f"{base}/rejects/tracks"),
    }
    people = spark.read.schema(customers.schema).json(f"{base}/intermediate/customers")
    report["customers"]["table"] = append_audited(spark, people, f"{base}/tables/customers", ["user_id"], f"{base}/rejects/customer_rows")
    moves = spark.read.schema(kept.schema).json(f"{base}/intermediate/tracks")
    yearly = trips.distance_by_year(moves.withColumn("year", F.year(parse_iso_utc("time_stamp"))), unit=unit)
    no_year = moves.where(F.year(parse_iso_utc("time_stamp")).isNull()).select(
        F.lit(None).cast("string").alias("file"), F.lit("time").alias("level"), F.lit("no_time").alias("reason"), F.to_json(F.struct(*moves.columns)).alias("content"))
    report["tracks"]["rejected_time"] = append_table([no_year], f"{base}/rejects/times")["rows_written"]
    report["tracks"]["table"] = append_audited(spark, yearly, f"{base}/tables/vehicle_distance", ["vehicle_id", "year"], f"{base}/rejects/distance_rows")
    return report


def upsert_partitions(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    keys: list[str],
    ts_col: str,
    *,
    partition_col: str = "year",
    partition_value=None,
    compression: str = "gzip",
) -> dict:
    """Upsert ``delta`` into a snapshot partitioned by a value of its rows (default: the year of ``ts_col``).

    Touched partitions are those of the delta's rows plus those that hold a delta key (found from the key and
    partition columns only), so a record that moves to another partition leaves no copy behind, and a partition that
    becomes empty goes.  They are read, merged and published in one step; all others keep their folders.  A NULL
    partition is one like any other.  A stored row newer than the delta's stays.  After a `manifest.Conflict` it
    raises; the caller runs it again.
    """
    value = partition_value if partition_value is not None else F.year(F.col(ts_col))
    part = F.coalesce(value.cast("string"), F.lit("null"))
    latest = dedupe_latest(delta, keys, ts=ts_col)
    stored = manifest.current(spark, path)
    if stored is None:
        done = manifest.replace(spark, path, latest.withColumn(partition_col, value), part, compression=compression)
        return {"initial": True, "partitions": None} | done
    side = latest.select(*[F.col(k).alias(f"__rl_k{i}") for i, k in enumerate(keys)])
    same = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__rl_k{i}"))
        same = c if same is None else same & c
    holding = stored.read().join(side, same, "left_semi").select(partition_col)
    values = {r[0] for r in latest.select(value).union(holding).distinct().toLocalIterator()}
    touched = {"null" if v is None else str(v) for v in values}
    merged = incremental.upsert(stored.read(touched).drop(partition_col), latest.select(*[c for c in stored.schema.names if c != partition_col]),
                                keys, ts_col=ts_col)
    done = manifest.replace(spark, path, merged.withColumn(partition_col, value), part, parts=touched, parent=stored, compression=compression)
    return {"initial": False, "partitions": sorted(values, key=lambda v: (v is None, v))} | done
