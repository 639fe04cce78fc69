"""Sinks (K1-K7).

Writes go through Spark's committers, so a lost executor only re-runs its
task and readers never see half a job.  Publishing a new snapshot writes a
new directory and then moves a small pointer: a reader of the pointer sees the
old or the new snapshot, never a mix, and the snapshot being replaced is never
read and overwritten by the same job.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadloom.sinks import manifest


def write_snapshot(
    df: DataFrame,
    path: str,
    *,
    compression: str = "gzip",
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Full load as compressed Parquet (K1).  With ``partition_by`` the
    overwrite is dynamic: only the partitions present in ``df`` are replaced."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_yearly(df: DataFrame, path: str, ts_col: str, *, compression: str = "gzip") -> None:
    """One partition per year of ``ts_col`` (K3, replaces year-named objects)."""
    write_snapshot(df.withColumn("year", F.year(ts_col)), path, compression=compression, partition_by=["year"])


def write_json_lines(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Records as JSON lines (K4)."""
    df.write.mode(mode).json(path)


def write_versioned(df: DataFrame, base: str, *, compression: str = "gzip") -> str:
    """Write ``df`` to a new version directory, then add a pointer to it.

    Pointers are small numbered folders and none is overwritten: the newest complete one counts, so a
    failure at any moment leaves the previous snapshot current.
    """
    spark = df.sparkSession
    version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    target = f"{base.rstrip('/')}/v={version}"
    counted = Observation("written")
    write_snapshot(df.observe(counted, F.count(F.lit(1)).alias("rows")), target, compression=compression)
    audit_change(0, rows_of(spark, target), {"rows_written": int(counted.get["rows"])})
    number = max([n for n, _ in _pointers(spark, base)], default=0) + 1
    spark.createDataFrame([(target,)], "path string").coalesce(1).write.text(
        f"{base.rstrip('/')}/{POINTERS}/{number:09d}-{uuid.uuid4().hex[:8]}")
    return target


POINTERS = "_pointers"


def _pointers(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """(number, path) of all complete pointers, newest last."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{POINTERS}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = [s.getPath() for s in fs.listStatus(root)
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted((int(p.getName().split("-")[0]), p.toString()) for p in done)


def has_current(spark: SparkSession, base: str) -> bool:
    """True when a snapshot was published."""
    return manifest.current(spark, base) is not None or bool(_pointers(spark, base))


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The newest snapshot: what the newest manifest holds, else the version that the newest complete pointer names."""
    snap = manifest.current(spark, base)
    if snap is not None:
        return snap.view()
    found = _pointers(spark, base)
    if not found:
        raise FileNotFoundError(f"no snapshot under {base!r}")
    return spark.read.parquet(spark.read.text(found[-1][1]).first()["value"])


def append_table(
    dfs: list[DataFrame],
    target: str,
    *,
    required: list[str] | None = None,
    rejects: str | None = None,
    as_table: bool = False,
) -> dict[str, int]:
    """Append several frames to a table (K5, U3) and report the load (K6).

    Rows missing a ``required`` column go to ``rejects`` (with a reason)
    instead of the table; ``required`` without ``rejects`` is an error, as rows would be lost.  Counts come from ``Observation`` metrics collected
    while writing (no second pass over the data); the returned dict has rows
    written and rows rejected.
    """
    if required and not rejects:
        raise ValueError("required columns need a rejects path")
    union = dfs[0]
    for d in dfs[1:]:
        union = union.unionByName(d, allowMissingColumns=True)
    bad = None
    for c in required or []:
        cond = F.col(c).isNull()
        bad = cond if bad is None else (bad | cond)
    good_obs = Observation("loaded")
    good = union if bad is None else union.where(~bad)
    good = good.observe(good_obs, F.count(F.lit(1)).alias("rows"))
    writer = good.write.mode("append")
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.parquet(target)
    stats = {"rows_written": int(good_obs.get["rows"]), "rows_rejected": 0}
    if bad is not None and rejects:
        rej_obs = Observation("rejected")
        missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
        rej = union.where(bad).withColumn("reject_reason", F.concat(F.lit("missing:"), missing))
        rej.observe(rej_obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(rejects)
        stats["rows_rejected"] = int(rej_obs.get["rows"])
    return stats


def audit_load(spark: SparkSession, target: str, expected_rows: int, *, as_table: bool = False) -> bool:
    """Rows in the target equal the rows we loaded (the loading test)."""
    return rows_of(spark, target, as_table=as_table) == expected_rows


def rows_of(spark: SparkSession, target: str, *, as_table: bool = False) -> int:
    """Rows in a target now; 0 when it does not exist yet."""
    if as_table:
        return spark.table(target).count() if spark.catalog.tableExists(target) else 0
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.parquet(target).count()


def audit_change(before: int, after: int, stats: dict[str, int]) -> dict[str, int]:
    """The audit of one load (K6): rows in the target before and after against the rows that the load says it wrote.

    Raises ValueError when they differ, so that a load that lost or doubled rows does not pass unseen.
    """
    if after - before != stats["rows_written"]:
        raise ValueError(f"{stats['rows_written']} rows written, the target went from {before} to {after}")
    return stats | {"rows_before": before, "rows_after": after}


def write_envelope(df: DataFrame, path: str, generated_at: dt.datetime | str) -> None:
    """The ``{data[], metadata}`` document as two tables: rows and one metadata
    row (K7).  Rows are never gathered into a single array."""
    from roadloom.operators.nested import metadata_row

    df.write.mode("overwrite").json(f"{path.rstrip('/')}/data")
    metadata_row(df, generated_at).coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/metadata")


def write_bucketed_table(
    df: DataFrame,
    table: str,
    keys: list[str],
    buckets: int,
    *,
    sort: bool = True,
    mode: str = "overwrite",
    path: str | None = None,
    compression: str = "gzip",
) -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) on ``keys``.

    Two tables bucketed on their join key with the same bucket count are
    joined without shuffling either side (and sort-merge needs no sort when
    both are sorted): for joins repeated every run, such as line items with
    orders, the shuffle is paid once at write time.  ``path`` keeps the data
    in a shared folder (external table).
    """
    w = df.write.mode(mode).option("compression", compression).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
