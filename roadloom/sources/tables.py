"""Table sources.

The reference sends whole SQL statements to a database and pulls the result
into one process.  Here only base tables are read; joins and aggregates run in
Spark.  A JDBC read is split into ``num_partitions`` range scans on a numeric
column so no single connection pulls the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, base: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Read table ``name``.

    With ``base`` the table is ``{base}/{name}.parquet`` (file or dataset
    directory) or ``{base}/{name}``; without it ``name`` is a catalog table.
    Column pruning and filters are pushed to the scan by Catalyst.
    """
    if base is None:
        return spark.table(name)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for candidate in (f"{base.rstrip('/')}/{name}.{fmt}", f"{base.rstrip('/')}/{name}"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(candidate)
        if path.getFileSystem(conf).exists(path):
            return spark.read.format(fmt).load(candidate)
    raise FileNotFoundError(f"table {name!r} not found under {base!r}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel JDBC scan of one base table.

    With a partition column the read is ``num_partitions`` range queries;
    Spark pushes column pruning and simple filters into each of them.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partition_column needs lower_bound and upper_bound")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def read_snapshot_keys(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Prior snapshot, pruned to the key columns (S2): only those are scanned."""
    return spark.read.parquet(path).select(*keys)
