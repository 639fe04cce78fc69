"""Copy-on-write snapshots by manifest.

A snapshot is a manifest: one row per partition, naming the folder that holds its rows and the fingerprint of these
rows.  A change writes the touched partitions to new folders and publishes one new manifest; the folders of all other
partitions are named again and keep their files.  Nothing that a manifest names is ever overwritten, so a reader between
any two steps sees a whole snapshot, the old or the new one.

Manifests are numbered.  A number is taken by one atomic rename that fails when it exists, so of two writers that
started from the same snapshot one is told that it lost (`Conflict`) and has to merge again.

The fingerprint of a partition is the number of its rows and two sums of 64-bit row hashes with different seeds: it does
not depend on the order of rows, adds up over files, and sees duplicates.  It is worked out from the new rows alone;
whether anything changed is then a comparison with the stored fingerprints, and no stored row is read for it.

    base/data/load=<id>/part=<partition>/part-*.parquet     rows
    base/_manifests/staged-<id>/                            manifest rows
    base/_manifests/000000007                               pointer: which staged manifest is snapshot 7
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"
#: Partitions of a key-bucketed snapshot unless told otherwise; about one per 256 MB of rows is a good choice.
BUCKETS = 16
#: What a partition may be called: it names a folder.
SAFE = "^[A-Za-z0-9_.-]+$"


class Conflict(RuntimeError):
    """Another writer has published since the snapshot was read."""


@dataclass(frozen=True)
class Partition:
    """A partition's folder, relative to the data folder, and the fingerprint of its rows."""

    folder: str
    rows: int
    sum_a: int
    sum_b: int

    @property
    def fingerprint(self) -> tuple[int, int, int]:
        return self.rows, self.sum_a, self.sum_b


@dataclass
class Snapshot:
    """One published state.  ``properties`` is small text that the writers keep beside the rows, such as marks."""

    spark: SparkSession
    base: str
    number: int
    schema: T.StructType
    parts: dict[str, Partition]
    properties: dict[str, str] = field(default_factory=dict)

    def read(self, parts: set[str] | None = None) -> DataFrame:
        """The rows, or those of some partitions only; only their folders are read."""
        names = sorted(p for p in self.parts if parts is None or p in parts)
        if not names:
            return self.spark.createDataFrame([], self.schema)
        data = f"{self.base}/data"
        schema = T.StructType([*self.schema, T.StructField("load", T.StringType()), T.StructField("part", T.StringType())])
        read = self.spark.read.schema(schema).option("basePath", data)
        return read.parquet(*[f"{data}/{self.parts[p].folder}" for p in names]).drop("load", "part")

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())

    def view(self) -> DataFrame:
        """What readers get: the rows, or what the view that the properties name makes of them."""
        if VIEW not in self.properties:
            return self.read()
        named = json.loads(self.properties[VIEW])
        return VIEWS[named["name"]](self.read(), **named["args"])


#: The property that names a view and its arguments, and the known views: functions of the rows and the arguments.
VIEW = "view"
VIEWS: dict[str, Callable[..., DataFrame]] = {}


def view_property(name: str, **args) -> dict[str, str]:
    return {VIEW: json.dumps({"name": name, "args": args}, sort_keys=True)}


def row_hash(columns: list[str], kinds: dict[str, str], seed: int) -> Column:
    """64-bit hash of a row in which NULLs and the place of a value count; nested values enter as JSON."""
    flat = []
    for c in columns:
        col = F.col(f"`{c}`")
        if kinds[c].startswith(("array", "struct", "map")):
            col = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
        flat += [col.isNull(), col]
    return F.xxhash64(F.lit(seed), *flat)


def fingerprints(df: DataFrame, part: str | Column, columns: list[str] | None = None) -> DataFrame:
    """Rows (part, rows, sum_a, sum_b): the fingerprint of each partition's rows.  One partial aggregation."""
    columns = columns if columns is not None else df.columns
    kinds = dict(df.dtypes)

    def total(seed: int) -> Column:
        return F.sum(row_hash(columns, kinds, seed).cast("decimal(20,0)"))

    return df.groupBy((F.col(part) if isinstance(part, str) else part).alias("part")).agg(
        F.count("*").alias("rows"), total(1).alias("sum_a"), total(2).alias("sum_b"))


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    """The partition of a row in a snapshot bucketed by ``keys`` (NULL is a key like any other)."""
    return F.pmod(F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]), F.lit(buckets)).cast("string")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, base: str) -> list[int]:
    root, fs = _hadoop(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(root):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(root) if s.isFile() and s.getPath().getName().isdigit())


def _load(spark: SparkSession, base: str, number: int) -> Snapshot:
    base = base.rstrip("/")
    pointer = json.loads(spark.read.text(f"{base}/{MANIFESTS}/{number:09d}", wholetext=True).first()["value"])
    schema = T.StructType.fromJson(pointer["schema"])
    rows = spark.read.schema("part string, folder string, rows long, sum_a decimal(38,0), sum_b decimal(38,0)").parquet(
        f"{base}/{MANIFESTS}/{pointer['staged']}")
    parts = {r["part"]: Partition(r["folder"], r["rows"], int(r["sum_a"]), int(r["sum_b"])) for r in rows.collect()}
    return Snapshot(spark, base, number, schema, parts, pointer["properties"])


def current(spark: SparkSession, base: str) -> Snapshot | None:
    """The newest snapshot, None when nothing was published."""
    numbers = _pointers(spark, base)
    return _load(spark, base, numbers[-1]) if numbers else None


def snapshot(spark: SparkSession, base: str, number: int) -> Snapshot:
    """An earlier snapshot, as long as `expire` has left it."""
    return _load(spark, base, number)


def _publish(spark: SparkSession, base: str, parent: int, schema: T.StructType, parts: dict[str, Partition], properties: dict[str, str]) -> int:
    staged = f"staged-{uuid.uuid4().hex}"
    rows = [(p, x.folder, x.rows, x.sum_a, x.sum_b) for p, x in sorted(parts.items())]
    frame = spark.createDataFrame([(a, b, c, str(d), str(e)) for a, b, c, d, e in rows], "part string, folder string, rows long, a string, b string")
    frame.select("part", "folder", "rows", F.col("a").cast("decimal(38,0)").alias("sum_a"), F.col("b").cast("decimal(38,0)").alias("sum_b")).coalesce(
        1).write.parquet(f"{base}/{MANIFESTS}/{staged}")
    pointer = json.dumps({"staged": staged, "schema": json.loads(schema.json()), "properties": properties, "parent": parent})
    jvm = spark.sparkContext._jvm
    temp, fs = _hadoop(spark, f"{base}/{MANIFESTS}/{staged}.pointer")
    out = fs.create(temp, True)
    out.write(bytearray(pointer.encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFESTS}/{parent + 1:09d}")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(temp), fs.makeQualified(target), options)
    except Exception as error:
        fs.delete(temp, False)
        if "FileAlreadyExists" in str(error):
            raise Conflict(f"snapshot {parent + 1} of {base} was published by another writer") from None
        raise
    return parent + 1


def replace(spark: SparkSession, base: str, rows: DataFrame, part: Column, *, parts: set[str] | None = None,
            parent: Snapshot | None = None, properties: dict[str, str] | None = None, compression: str = "gzip") -> dict:
    """Publish ``rows`` in place of the partitions ``parts`` (None: of the whole snapshot ``parent``).

    ``part`` names a row's partition (letters, digits, ``_ . -``; NULL is "null").  Rows are evaluated once, into new
    folders; a partition whose fingerprint is the stored one keeps its old folder, and when all do (and ``properties`` stay
    too) nothing is published.  A replaced partition without rows goes.  Large partitions are written by several tasks.
    The rows read back are counted against those written before anything is published.  Returns changed, version (the
    number), written and kept (partitions), rows_before and rows_after.  Raises `Conflict` when a snapshot newer than
    ``parent`` exists.
    """
    base = base.rstrip("/")
    properties = properties if properties is not None else dict(parent.properties) if parent else {}
    if parent is not None:
        rows = rows.select(*parent.schema.names)
    columns, load = rows.columns, f"load={uuid.uuid4().hex}"
    if {"load", "part"} & {c.lower() for c in columns}:
        raise ValueError("columns load and part are the snapshot's own")
    named = F.coalesce(part.cast("string"), F.lit("null"))
    named = F.when(named.rlike(SAFE), named).otherwise(F.raise_error(F.concat(F.lit("no name for a partition: "), named)).cast("string"))
    target = f"{base}/data/{load}"
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    counted = Observation("written")
    (rows.withColumn("part", named).hint("rebalance", F.col("part")).observe(counted, F.count(F.lit(1)).alias("rows"))
     .write.option("compression", compression).partitionBy("part").parquet(target))
    with_part = T.StructType([*schema, T.StructField("part", T.StringType())])
    found = {r["part"]: Partition(f"{load}/part={r['part']}", r["rows"], int(r["sum_a"]), int(r["sum_b"]))
             for r in fingerprints(spark.read.schema(with_part).parquet(target), "part", columns).collect()}
    if sum(x.rows for x in found.values()) != counted.get["rows"]:
        raise ValueError(f"{counted.get['rows']} rows were written to {target}, {sum(x.rows for x in found.values())} are there")
    old = parent.parts if parent else {}
    if parts is not None and (strange := set(found) - parts):
        raise ValueError(f"rows of partitions that are not replaced: {sorted(strange)[:5]}")
    out = {p: x for p, x in old.items() if parts is not None and p not in parts}
    same = {p for p, x in found.items() if p in old and old[p].fingerprint == x.fingerprint}
    out |= {p: old[p] if p in same else x for p, x in found.items()}
    _drop(spark, f"{base}/data", [found[p].folder for p in same])
    gone = set(old) - set(out)
    written = sorted(set(found) - same)
    if parent and not written and not gone and properties == parent.properties:
        _drop(spark, f"{base}/data", [load])
        return {"changed": False, "version": None, "written": [], "kept": len(out), "rows_before": parent.rows, "rows_after": parent.rows}
    version = _publish(spark, base, parent.number if parent else 0, schema, out, properties)
    return {"changed": True, "version": version, "written": written, "kept": len(out) - len(written),
            "rows_before": parent.rows if parent else 0, "rows_after": sum(x.rows for x in out.values())}


def merge(spark: SparkSession, base: str, delta: DataFrame, part: Column, combine: Callable[[DataFrame | None, DataFrame], DataFrame], *,
          twins: Callable[[str], set[str]] | None = None, result_part: Column | None = None,
          properties: dict[str, str] | None = None, attempts: int = 3) -> dict:
    """Publish ``combine(stored rows of the touched partitions, delta)``; reads and writes only partitions that ``delta`` has.

    ``part`` must put the result's rows into the partitions that the delta's rows are in, as a bucket of the key does; else
    ``result_part`` puts them into the ``twins`` of those partitions.  ``combine`` gets None for the stored rows when nothing
    was published.  After a `Conflict` it starts again from the snapshot published meanwhile, ``attempts`` times in all.
    """
    named = F.coalesce(part.cast("string"), F.lit("null"))
    result_part = part if result_part is None else result_part
    for attempt in range(attempts):
        parent = current(spark, base)
        try:
            if parent is None:
                return replace(spark, base, combine(None, delta), result_part, properties=properties) | {"initial": True}
            touched = {r[0] for r in delta.select(named).distinct().toLocalIterator()}
            touched = {q for p in touched for q in twins(p)} if twins else touched
            return replace(spark, base, combine(parent.read(touched), delta), result_part, parts=touched, parent=parent,
                           properties=None if properties is None else parent.properties | properties) | {"initial": False}
        except Conflict:
            if attempt + 1 == attempts:
                raise
    raise AssertionError("unreachable")


def _drop(spark: SparkSession, root: str, folders: list[str]) -> None:
    for folder in folders:
        path, fs = _hadoop(spark, f"{root}/{folder}")
        fs.delete(path, True)


def expire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete what only snapshots older than the newest ``keep`` name; returns the folders deleted.

    Not to be run while a writer is at work: folders that no manifest names yet would go too.
    """
    base = base.rstrip("/")
    numbers = _pointers(spark, base)
    kept = [_load(spark, base, n) for n in numbers[-keep:]]
    named = {p.folder for s in kept for p in s.parts.values()}
    root, fs = _hadoop(spark, f"{base}/data")
    gone = []
    for load in fs.listStatus(root) if fs.exists(root) else []:
        folders = [f"{load.getPath().getName()}/{s.getPath().getName()}" for s in fs.listStatus(load.getPath()) if s.isDirectory()]
        dead = [f for f in folders if f not in named]
        gone += [load.getPath().getName()] if len(dead) == len(folders) else dead
    _drop(spark, f"{base}/data", gone)
    _drop(spark, f"{base}/{MANIFESTS}", [f"{n:09d}" for n in numbers[:-keep]])
    return len(gone)
