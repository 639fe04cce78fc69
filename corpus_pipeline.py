"""Corpus pipeline: language ID, exact, near and substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; ``run`` writes each result
as Parquet under the shared checkpoint folder and reads it again.  Stages keep the columns of ``documents`` as they
are (extra ones too), but for the text that substring dedup shortens; the last stage returns the pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import chunkdedup, exact, langid, minhash, packing
from roadloom.llm.base import held_out, shared_checkpoints, table

#: No SQL for sampling-free but hash-based stages; tests compare `run` with a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: NULL texts and texts without letters."""
    model = langid.fit(docs.filter(~held_out()).select("text", "lang"))
    return langid.keep_identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of equal texts."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of similar texts (five words, 0.8)."""
    return minhash.drop_near(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages out of texts that an earlier document has; every document stays, if empty."""
    return chunkdedup.drop_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of 2048 tokens."""
    return packing.digest(packing.pack(docs.select("doc_id", "text")))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    shared_checkpoints(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder.toString()}/{name}")
        docs = spark.read.parquet(f"{folder.toString()}/{name}")
    out = STAGES[-1][1](spark, docs, sf_dir)
    # packing has its own checkpoint by now
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return out
