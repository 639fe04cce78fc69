"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so, each chunk is named by a 64-bit digest, and the digests are
verified: two chunks that share one must be the same text, or they get different identifiers.  After that
a document is a short list of identifiers, and documents are equal when their lists are.  The text itself
moves once, chunk by chunk, and equal chunks already meet before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadloom.llm.base import stable, table

#: A chunk ends at the first boundary after MIN_CHUNK characters and has at most MAX_CHUNK.
MIN_CHUNK, MAX_CHUNK = 1024, 4096
#: A boundary is a space after one letter of the first class and one sign of the second.
BOUNDARY = "[aeiou][^aeiou ] "
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of ASCII white space as one space; NULL as an empty text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(col, F.lit("")), SPACES, " ")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks in order, which put together are the text; an empty text has none."""
    pattern = f"(?s).{{{least},{most}}}?(?<={BOUNDARY})|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after `normalised`.  keep_id is the smallest doc_id of the group (NULL if all are
    NULL), group_size its rows, kept true for one row with that id.  A row that repeats another (same id and
    text) counts in group_size and is not kept; of rows with the smallest id one stays, so each group keeps
    one row.  Empty and NULL texts form one group; an empty table gives no rows; other columns are ignored.
    ``digest`` names a chunk by a long; a weak one only costs time, as identifiers are verified on the text.
    """
    text = docs.select("doc_id", normalised().alias("norm"))
    cut = text.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(digest(F.col("chunk")).alias("digest"), "chunk")
    clashes = stable(cut.groupBy("digest").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
                     .filter("a <> b").select("digest"))
    rows = text.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), chunks(F.col("norm")).alias("chunks")).select(
        "doc_id", "text_sha256", F.transform("chunks", lambda c: digest(c)).alias("recipe"))
    if clashes.isEmpty():
        rows = rows.withColumn("variants", F.lit(None).cast("array<int>"))
    else:
        rows = rows.join(_variants(text, clashes, digest), F.col("text_sha256") == F.col("sha"), "left").drop("sha")
    # rows alike in id and list are numbered, so that exactly one can be kept
    rows = rows.withColumn("nth", F.row_number().over(
        Window.partitionBy("doc_id", "recipe", "variants").orderBy("text_sha256")))
    key = F.struct("recipe", "variants")
    rows = rows.select("doc_id", "text_sha256", "nth", key.alias("key"))
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.withColumnRenamed("key", "group_key")
    return rows.join(groups, F.col("key").eqNullSafe(F.col("group_key"))).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def _variants(text: DataFrame, clashes: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """For texts that hold a digest shared by different chunks: which of those chunks stands at each place."""
    placed = (text.groupBy(F.sha2("norm", 256).alias("sha")).agg(F.min("norm").alias("norm"))
              .select("sha", F.posexplode(chunks(F.col("norm"))).alias("at", "chunk"))
              .withColumn("digest", digest(F.col("chunk"))).join(clashes, "digest", "left_semi"))
    # the different chunks of one digest: by a longer digest here, compared in full when they are numbered
    named = placed.groupBy("digest", "chunk").agg(F.lit(1).alias("one"))
    number = named.withColumn("variant", F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))).drop("one")
    return (placed.join(number, ["digest", "chunk"]).groupBy("sha")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "variant"))), lambda x: x.variant).alias("variants")))


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat another row's text (the smallest doc_id of equal texts stays).

    All columns are kept, whatever their names.  Rows that share id and text are reduced to one.  Texts of any length
    are compared whole; NULL and empty texts are equal; an empty table stays empty.
    """
    kept = exact_groups(docs.select("doc_id", "text")).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    plain = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (F.col(plain[docs.columns.index(c)]) for c in ("doc_id", "text"))
    rows = docs.toDF(*plain).withColumn("sha", F.sha2(normalised(text), 256))
    one = Window.partitionBy("kept_id", "kept_sha").orderBy("kept_id")
    return (rows.join(kept, (F.col("sha") == F.col("kept_sha")) & doc_id.eqNullSafe(F.col("kept_id")))
            .withColumn("nth", F.row_number().over(one)).filter("nth = 1").select(*plain).toDF(*docs.columns))


def op5_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all ``documents``; see `exact_groups`."""
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, CAST(count(*) OVER (PARTITION BY n) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, text_sha256
FROM t
"""
