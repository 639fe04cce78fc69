"""Concatenate-and-cut packing of token sequences by two passes of prefix sums.

Pass one encodes each document once and notes, per partition, where each document starts; the partition
totals alone are summed up across partitions.  Pass two adds a partition's global start to its local ones and
cuts at every multiple of the sequence length.  A document that crosses a cut gives one record on either side.
Nothing is shuffled, and only the very last sequence can need padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import ship, slices, stable, table
from roadloom.llm.wordids import encoder, word_bpe_path

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Text bytes encoded at once: a quarter of the usual ones, as the executors' memory is short after the stages before.
SLICE = 1 << 20


def token_rows(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Pass one: (part, local_start, doc_id, ids) with ids as little-endian unsigned 16-bit numbers, end id included."""

    def encode(batches):
        part = TaskContext.get().partitionId()
        enc, start = encoder(path), 0
        for batch in batches:
            for low, high in slices(batch.column(1), SLICE):
                ids, offsets = enc.encode(batch.column(1).slice(low, high - low))
                if len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("this vocabulary needs ids of more than 16 bits")
                n = high - low
                ids = np.insert(ids, offsets[1:], end_id).astype("<u2")
                offsets = offsets + np.arange(n + 1)
                data = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets * 2), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, dtype=np.int32)), pa.array(start + offsets[:-1]),
                     batch.column(0).slice(low, n), data.cast(pa.binary())],
                    names=["part", "local_start", "doc_id", "ids"])
                start += int(offsets[-1])

    return docs.mapInArrow(encode, "part int, local_start long, doc_id long, ids binary")


def pack(docs: DataFrame, path: str | None = None, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents (columns doc_id, text) in sequences of ``sequence_tokens``.

    Returns per piece: doc_id, start (the document's ids before it), length, ids (binary, little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset (place in the sequence).  Every id lies in exactly one piece and
    sequences are filled without gaps in the order partitions and rows are read; all but the last are full.
    A NULL or empty text has only the end id.  NULL and repeated doc_ids are ordinary documents, an empty
    table gives no pieces, and very long texts give as many pieces as they need.  Driver memory: one number
    per input partition.
    """
    ship(docs.sparkSession)
    base = stable(token_rows(docs.select(F.col("doc_id").cast("long"), "text"), path or word_bpe_path(), end_id))
    starts = np.zeros(base.rdd.getNumPartitions() + 1, dtype=np.int64)
    for p, n in base.groupBy("part").agg(F.sum(F.octet_length("ids") / 2).cast("long")).toLocalIterator():
        starts[p + 1] = n
    starts = np.cumsum(starts)

    def cut(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            data = batch.column(3)
            at = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset:data.offset + n + 1].astype(np.int64) // 2
            ids = np.frombuffer(data.buffers()[2], dtype="<u2")
            tokens = np.diff(at)
            first = starts[batch.column(0).to_numpy()] + batch.column(1).to_numpy()
            pieces = (first + tokens - 1) // sequence_tokens - first // sequence_tokens + 1
            row = np.repeat(np.arange(n), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] // sequence_tokens + nth
            begin = np.maximum(sequence * sequence_tokens, first[row])
            length = np.minimum((sequence + 1) * sequence_tokens, (first + tokens)[row]) - begin
            # pieces of consecutive documents follow one another, so their ids are one stretch
            flat = ids[at[0]:at[-1]].astype("<u4")
            ends = np.concatenate([[0], np.cumsum(length)]) * 4
            out = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(row)), pa.array(begin - first[row]), pa.array(length), out.cast(pa.binary()),
                 pa.array(tokens[row]), pa.array(sequence), pa.array(begin % sequence_tokens)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return base.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 tokens; one row per piece."""
    return digest(pack(table(spark, sf_dir, "documents").select("doc_id", "text")))
