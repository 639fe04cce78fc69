"""Exact top-k search: tiled matrix products, selection per tile, tree merge of the per-query lists.

Queries are cut into blocks and candidates into shards, both of bounded size.  Each (block, shard) pair is one
tile: a task multiplies the two integer matrices and keeps the k best of each query.  The lists of a query are
then merged by a tree of bounded fan-in until one is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import ship, table

K = 10
QUERY_EVERY = 100
SCALE = 1024
BLOCK_QUERIES = 4096
SHARD_ROWS = 4096
#: Lists that one merge step puts together.
FAN_IN = 16

LIST = "array<struct<neg:bigint,vec_id:bigint>>"


def usable(vector: str | Column) -> Column:
    """True for a vector that is not NULL and has only finite components (an empty one has no components: False)."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def integers(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as long."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(v, lambda x: F.floor(x.cast("double") * scale))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows; a sum beyond 64 bits is set to the nearest 64-bit number."""
    top = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if top < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2.0**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best_of_tile(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best candidates of each query, best first, ties to the smaller id; -1 where there are fewer."""
    order = np.lexsort((ids,))
    s = scores[:, order]
    if s.shape[1] > k:  # all above the k-th score, then its ties by id
        kth = -np.partition(-s.astype(object) if s.min() == -(2**63) else -s, k - 1, axis=1)[:, k - 1]
        out = np.empty((len(s), k), dtype=np.int64)
        for q in range(len(s)):
            over = np.flatnonzero(s[q] > kth[q])
            ties = np.flatnonzero(s[q] == kth[q])[:k - len(over)]
            got = np.concatenate([over, ties])
            out[q] = got[np.lexsort((got, -s[q][got]))]
        return order[out]
    return order[np.argsort(-s, axis=1, kind="stable")]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, block_queries: int = BLOCK_QUERIES,
          shard_rows: int = SHARD_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """The k best candidates of each query by integer inner product: query_id, rank (from 1), vec_id, score.

    Both frames have vec_id (long) and v (array of long).  Ties go to the smaller vec_id.  A candidate with the
    query's own vec_id is left out; rows without vec_id or v take no part; only vectors of equal length are
    compared.  Query rows that repeat a vec_id count once (the smallest vector); candidate rows that repeat one
    are candidates each.  Fewer than k candidates give fewer rows, an empty side gives none.  Scores beyond 64
    bits are set to the nearest 64-bit number.

    Tiles hold at most about block_queries x shard_rows rows on either side; every candidate is sent once per
    query block and every query once per shard.
    """
    spark = queries.sparkSession
    ship(spark)
    fine = F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    q = queries.filter(fine).groupBy("vec_id").agg(F.min("v").alias("v"))
    c = candidates.filter(fine).select("vec_id", "v")
    blocks = max(1, -(-queries.count() // block_queries))
    shards = max(1, -(-candidates.count() // shard_rows))
    # the whole row decides the shard of a candidate, so rows that share an id spread as their vectors do
    q = q.select(F.lit(0).alias("side"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                 F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "vec_id", "v")
    c = c.select(F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                 F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "v")

    def tile(key, group):
        block, shard = (x.as_py() for x in key)
        side, ids = group["side"].to_numpy(), group["vec_id"].to_numpy()
        flat = group["v"].combine_chunks()
        size = np.diff(flat.offsets.to_numpy())
        values, starts = flat.values.to_numpy(zero_copy_only=False), flat.offsets.to_numpy()[:-1]
        out_q, out_lists = [], []
        for dim in np.unique(size[side == 0]):
            qa, ca = np.flatnonzero((side == 0) & (size == dim)), np.flatnonzero((side == 1) & (size == dim))
            if not len(ca):
                continue
            cm = values[starts[ca][:, None] + np.arange(dim)]
            for at in range(0, len(qa), 256):
                some = qa[at:at + 256]
                scores = products(values[starts[some][:, None] + np.arange(dim)], cm)
                for qi, row, best in zip(some, scores, best_of_tile(scores, ids[ca], k + int(np.unique(ids[ca], return_counts=True)[1].max()))):
                    best = best[ids[ca][best] != ids[qi]][:k]
                    out_q.append(ids[qi])
                    out_lists.append([{"neg": int(~row[b]), "vec_id": int(ids[ca][b])} for b in best])
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "node": pa.array([shard] * len(out_q), pa.int64()),
                         "best": pa.array(out_lists, pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())])))})

    lists = (q.unionByName(c).groupBy("block", "shard")
             .applyInArrow(tile, f"query_id bigint, node bigint, best {LIST}"))
    nodes = shards
    while True:  # neg is ~score, so ascending order is best first
        nodes = -(-nodes // fan_in)
        lists = (lists.groupBy("query_id", F.expr(f"node div {fan_in}").alias("node"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best")))
        if nodes == 1:
            break
    return lists.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        F.bitwise_not(F.col("b.neg")).alias("score"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows of ``embeddings`` for each vec_id divisible by 100, by integer inner product of floor(1024 x)."""
    vectors = (table(spark, sf_dir, "embeddings").filter(usable("embedding"))
               .select(F.col("vec_id").cast("long").alias("vec_id"), integers("embedding").alias("v")))
    return top_k(vectors.filter(F.col("vec_id") % QUERY_EVERY == 0), vectors)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
