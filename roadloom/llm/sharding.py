"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of each input partition go to each shard is drawn first, from the law a uniform shuffle of
all rows would give (a multivariate hypergeometric matrix with the partition sizes as row sums and the shard
sizes as column sums).  Each partition then deals its rows out by a random permutation of its labels, rows
are exchanged, and every shard is permuted again.  No row is looked at more than once per step and no step
needs a global sort: the matrix is not built in one place either, a task draws only its own row by walking
down a binary tree over the partitions with random numbers that belong to the tree's nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.llm.base import ship, stable, table

N_SHARDS = 24
SEED = 20240229
#: Rows of a shard that are put in order together, on average.
CELL_ROWS = 2048
#: numpy draws below this population; larger ones are drawn by inversion around the mode.
NUMPY_LIMIT = 900_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items, taken without replacement, are among the ``good`` ones; any population size."""
    if good == 0 or drawn == 0:
        return 0
    if bad == 0:
        return drawn
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn))
    low, high = max(0, drawn - bad), min(drawn, good)
    total = good + bad
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / total)) ** 0.5
    mode = (drawn + 1) * (good + 1) // (total + 2)
    low, high = max(low, int(mode - 12 * spread - 10)), min(high, int(mode + 12 * spread + 10))
    k = np.arange(low, high, dtype=np.float64)
    steps = (np.log(good - k) + np.log(drawn - k)) - (np.log(k + 1) + np.log(bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    cdf = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"))


def split_counts(rng: np.random.Generator, capacity: np.ndarray, drawn: int) -> np.ndarray:
    """Multivariate hypergeometric: how many of ``drawn`` rows fall to each shard with the given free places."""
    out = np.zeros(len(capacity), dtype=np.int64)
    rest = int(capacity.sum())
    for j, places in enumerate(capacity.tolist()):
        rest -= places
        out[j] = hypergeometric(rng, places, rest, drawn)
        drawn -= int(out[j])
    return out


def matrix_row(sizes_before: np.ndarray, shard_sizes: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix.

    ``sizes_before`` are the prefix sums of the partition sizes (one entry more than partitions).  All tasks
    draw the same numbers at the same node, so the rows fit together without a common table.
    """
    low, high = 0, len(sizes_before) - 1
    capacity = shard_sizes.astype(np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        rng = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = split_counts(rng, capacity, int(sizes_before[mid] - sizes_before[low]))
        if part < mid:
            capacity, high = left, mid
        else:
            capacity, low = capacity - left, mid
    return capacity


def shard_sizes(total: int, n_shards: int) -> np.ndarray:
    """Exact sizes, at most one row apart; the first shards take the rows left over."""
    return np.array([total // n_shards + (j < total % n_shards) for j in range(n_shards)], dtype=np.int64)


def uniform_shards(df: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED,
                   shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """All rows of ``df`` with ``shard_col`` (int, from 0) and ``slot_col`` (long, gapless from 0 in each shard).

    Every assignment of rows to (shard, slot) places is equally likely; shard row counts differ by one at
    most.  ``df`` is written to the checkpoint folder first, because partition sizes and rows must stay the
    same between the passes (also when an executor is lost).  Each row counts on its own: NULLs in any
    column, repeated rows and repeated ids need no care.  An empty ``df`` gives an empty result.  ``df`` must
    not have columns of the two output names; other columns are carried along.
    Driver memory: one number per input partition.
    """
    if {shard_col, slot_col} & set(df.columns):
        raise ValueError(f"df already has {shard_col} or {slot_col}")
    ship(df.sparkSession)
    names, df = df.columns, df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    base = stable(df)
    n_parts = base.rdd.getNumPartitions()
    sizes = np.zeros(n_parts, dtype=np.int64)
    for p, n in base.groupBy(F.spark_partition_id().alias("p")).count().toLocalIterator():
        sizes[p] = n
    before = np.concatenate([[0], np.cumsum(sizes)])
    total = int(before[-1])
    places = shard_sizes(total, n_shards)
    cells = max(1, -(-int(places.max()) // CELL_ROWS))

    def deal(batches):
        part = TaskContext.get().partitionId()
        rng = np.random.Generator(np.random.PCG64([seed, part]))
        labels = np.repeat(np.arange(n_shards, dtype=np.int32), matrix_row(before, places, part, seed))
        rng.shuffle(labels)
        at = 0
        for batch in batches:
            n = batch.num_rows
            place = rng.integers(0, 1 << 62, n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[at:at + n]), pa.array(place),
                 pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at, at + n))],
                names=[*batch.schema.names, shard_col, "__place", "__part", "__row"])
            at += n

    schema = T.StructType([*df.schema.fields, T.StructField(shard_col, T.IntegerType()),
                           T.StructField("__place", T.LongType()), T.StructField("__part", T.IntegerType()),
                           T.StructField("__row", T.LongType())])
    cell = (F.col("__place").cast("double") / float(1 << 62) * cells).cast("long")
    dealt = base.mapInArrow(deal, schema).withColumn("__cell", F.least(cell, F.lit(cells - 1)))
    in_shard = Window.partitionBy("__s").orderBy("__c")
    starts = (dealt.groupBy(F.col(shard_col).alias("__s"), F.col("__cell").alias("__c")).agg(F.count("*").alias("__n"))
              .withColumn("__start", F.sum("__n").over(in_shard) - F.col("__n")).drop("__n"))
    in_cell = Window.partitionBy(shard_col, "__cell").orderBy("__place", "__part", "__row")
    return (dealt.withColumn("__rank", F.row_number().over(in_cell) - 1)
            .join(starts, (F.col(shard_col) == F.col("__s")) & (F.col("__cell") == F.col("__c")))
            .withColumn(slot_col, F.col("__start") + F.col("__rank"))
            .select(*df.columns, shard_col, slot_col).toDF(*names, shard_col, slot_col))


def op9_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23 under the ``rows`` law: shard counts are at most one apart.

    ``size`` is the text's UTF-8 bytes plus 8, ``text_crc32`` the crc32 of those bytes; a NULL text counts as
    empty, a NULL doc_id is kept as it is.  Only these narrow columns are exchanged.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return uniform_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
