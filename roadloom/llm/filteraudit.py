"""How quality filters interact: what each one removes in every order in which they may be applied.

Each document is measured once and becomes a mask of the filters that it fails.  Documents alike in part and mask
are one cell from then on.  A recursive query extends prefixes of filter orders by the letters they do not have yet;
every row carries a mask and the bits applied so far, and each level of the recursion gives one step's outcome for
each mask.  Joined with the cells' counts, the levels are the steps of all orders.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadloom.llm.base import dense, ship, slices, stable, table, word_codes

LEAST_WORDS = 200
#: Distinct words and capital letters, in hundredths.
LEAST_DISTINCT, MOST_CAPITALS = 50, 2
#: Characters that no kept document may hold.
MARKS = b"#$%&*|"
#: The filters; a document's mask has bit i when it fails the i-th.
LETTERS = "ABCDE"
#: The recursion and the order table grow with the factorial of the number of filters.
MOST_LETTERS = 7

_CAPITAL, _MARK, _START = np.zeros(256, np.bool_), np.zeros(256, np.bool_), np.ones(256, np.bool_)
_CAPITAL[ord("A"):ord("Z") + 1] = True
_MARK[list(MARKS)] = True
_START[0x80:0xC0] = False


def _sums(hits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])[at])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of dense texts."""
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[:len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return at, np.frombuffer(texts.buffers()[2], dtype=np.uint8)[:at[-1]] if at[-1] else np.zeros(0, np.uint8)


def text_failures(texts: pa.Array) -> np.ndarray:
    """Bits 1 (few words), 2 (few distinct words), 4 (many capitals), 8 (marks) of whole texts; NULL is an empty text."""
    texts = dense(texts)
    n = len(texts)
    codes, offsets, _ = word_codes(texts, lower="none")
    words = np.diff(offsets)
    width = int(codes.max(initial=0)) + 1
    pairs = np.sort(np.repeat(np.arange(n), words) * width + codes)
    first = np.concatenate([[True], pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.bool_)
    distinct = np.bincount(pairs[first] // width, minlength=n)
    at, data = _bytes_of(texts)
    capitals, marks, points = (_sums(kind[data], at) for kind in (_CAPITAL, _MARK, _START))
    return ((words < LEAST_WORDS) * 1 + (100 * distinct < LEAST_DISTINCT * words) * 2
            + (100 * capitals > MOST_CAPITALS * points) * 4 + (marks > 0) * 8).astype(np.int32)


def document_masks(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, text, source): doc_id, part, mask with bits A = 1 to E = 16.

    part is the source, an empty string for NULL.  A NULL text is an empty one, which fails A and, if a smaller
    doc_id is empty too, E.  Texts of any length are read whole.  Rows that repeat a doc_id are documents of their own; E
    needs a smaller doc_id with the same text, so the rows with a text's smallest doc_id pass, and so does a
    NULL doc_id, which is smaller than nothing either.  An empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                some = batch.slice(low, high - low)
                texts = dense(some.column(1))
                at, data = _bytes_of(texts)
                raw = memoryview(data)
                digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(digests, pa.binary()), pa.array(text_failures(texts))],
                                                 names=["doc_id", "part", "digest", "mask"])

    rows = stable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                              F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
                  .mapInArrow(measure, "doc_id long, part string, digest binary, mask int"))
    # one row per text; a join on both columns deals the copies of one text apart
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "of")
    late = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(firsts, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left").select(
        "doc_id", "part", F.when(late, F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")).alias("mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts (part, mask, n, good, toxic): documents, those labelled quality 1 and those labelled toxic 1.

    Label rows that share a doc_id count once: a document is good (toxic) when any of them says so.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("q"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("t"))
    return masks.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("q"), F.lit(0)).alias("good"), F.coalesce(F.sum("t"), F.lit(0)).alias("toxic"))


STEPS = """
WITH RECURSIVE unused AS (
  SELECT b.id AS bits, l.letter, l.bit FROM range({subsets}) AS b LATERAL VIEW inline({letters}) l AS letter, bit WHERE (b.id & l.bit) = 0
), prefixes AS (
  SELECT DISTINCT mask, CAST('' AS STRING) AS prefix, CAST(0 AS BIGINT) AS bits, 0 AS step, CAST('' AS STRING) AS letter, CAST(0 AS BIGINT) AS bit
  FROM {cells}
  UNION ALL
  SELECT p.mask, concat(p.prefix, u.letter), p.bits | u.bit, p.step + 1, u.letter, u.bit
  FROM prefixes p JOIN unused u ON p.bits = u.bits
)
SELECT mask, prefix, bits ^ bit AS applied, step, letter, bit FROM prefixes WHERE step > 0
"""


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Each part's outcome of every step of every order of the filters.

    ``counts`` has part, mask, n, good, toxic; bit i of a mask is the filter ``letters[i]`` (7 letters at most).  Returns
    part, filter_order, step (int, from 1), and as long kept (after the step), removed (by it), redundant (it fails
    them, an earlier one removed them), unique_fails (only its filter fails them), good_lost and toxic_lost (of the
    removed), shapley (what the step's filter removes, summed over all orders).  Every part has a row for each
    order and step, with zeros where nothing happens; no counts give no rows.
    """
    if not 0 < len(letters) <= MOST_LETTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_LETTERS} different letters are needed")
    spark = counts.sparkSession
    named = ", ".join(f"named_struct('letter', '{x}', 'bit', CAST({1 << i} AS BIGINT))" for i, x in enumerate(letters))
    counts = stable(counts.withColumn("mask", F.col("mask").cast("long")))
    # at most 2 ** letters masks times the prefixes, whatever the data
    steps = stable(spark.sql(STEPS.replace("{letters}", f"array({named})").replace("{subsets}", str(1 << len(letters))), cells=counts))
    mask, n = F.col("mask"), F.col("n")
    failed = mask.bitwiseAND(F.col("bit")) != 0
    there = mask.bitwiseAND(F.col("applied")) == 0

    def total(when, what=n):
        return F.sum(F.when(when, what).otherwise(0)).cast("long")

    outcome = counts.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter").agg(
        total(there & ~failed).alias("kept"), total(there & failed).alias("removed"), total(~there & failed).alias("redundant"),
        total(mask == F.col("bit")).alias("unique_fails"), total(there & failed, F.col("good")).alias("good_lost"),
        total(there & failed, F.col("toxic")).alias("toxic_lost"))
    # a prefix begins (letters - step)! orders
    orders_of = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - s)) for s in range(1, len(letters) + 1)]), F.col("step"))
    outcome = outcome.withColumn("shapley", F.sum(F.col("removed") * orders_of).over(Window.partitionBy("part", "letter")))
    orders = (steps.filter(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
              .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("at"))
              .select("filter_order", F.substring("filter_order", F.lit(1), F.col("at")).alias("prefix")))
    return outcome.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over all ``documents`` with their ``labels``, in all 120 orders, per source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(cells(document_masks(docs), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")))


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), masks AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM words
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(q), 0) AS good, coalesce(sum(x), 0) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), prefixes AS (
  SELECT '' AS prefix, 0 AS applied, 0 AS bits, 0 AS step, '' AS letter, 0 AS bit
  UNION ALL
  SELECT prefix || l.letter, bits, bits | l.bit, step + 1, l.letter, l.bit FROM prefixes p JOIN letters l ON (p.bits & l.bit) = 0
), outcome AS (
  SELECT part, prefix, step, letter,
         sum(CASE WHEN mask & bits = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & applied <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, prefixes WHERE step > 0 GROUP BY part, prefix, step, letter
), rows_of AS (
  SELECT o.part, f.prefix AS filter_order, o.step, o.letter, o.kept, o.removed, o.redundant, o.unique_fails, o.good_lost, o.toxic_lost
  FROM outcome o JOIN prefixes f ON f.step = 5 AND starts_with(f.prefix, o.prefix)
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM rows_of
"""
