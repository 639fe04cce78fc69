"""Token-id files: one compressed frame per document, one zstandard dictionary for all, an offset index per file.

The dictionary is trained on serialised id arrays of a bounded sample of short documents, which alone are too short to
compress well.  Files hold documents in ascending doc_id order, file after file; Spark's own writer writes them, so any
file system that Spark knows will do and a lost task leaves no half file.  A file is

    header   magic, bytes of an id, SHA-256 of the dictionary (zeros for none), file number
    frames   one zstandard frame per document: its ids, little-endian, end id included
    index    doc_ids, whether each is one, where each frame starts, ids of each document; compressed
    footer   place and size of the index, its crc32, documents, ids

each piece followed by one line feed, the writer's row separator.  So one document is read from the footer, the index and
its own frame, whatever the file's size.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import shared_checkpoints, ship, slices, stable, table
from roadloom.llm.wordids import encoder, word_bpe_path

END_ID = 2
LEVEL = 3
#: Text bytes of a file, on average.
FILE_BYTES = 32 << 20
#: The dictionary's size and the sample it is trained on: so many documents of at most so many bytes of text.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_TEXT = 32 << 10, 1000, 4096

#: Fixed values of the format.
MAGIC = b"RLTOKENS"
HEADER, FOOTER = "<8sB32sq", "<qqIqq8s"
BREAK = b"\n"


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for texts like ``samples``; their end, as it is, when they are too few; empty for none."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def encoded_slices(batch: pa.RecordBatch, path: str, end_id: int):
    """(first row, rows, ids with the end ids, offsets) of consecutive rows of a batch (doc_id, text)."""
    for low, high in slices(batch.column(1)):
        ids, offsets = encoder(path).encode(batch.column(1).slice(low, high - low))
        yield low, high - low, np.insert(ids, offsets[1:], end_id), offsets + np.arange(high - low + 1)


def sample_dictionary(docs: DataFrame, path: str, end_id: int, width: str) -> bytes:
    """Trained on the SAMPLE_DOCS documents of SAMPLE_TEXT bytes at most whose ids have the smallest hashes."""
    short = docs.filter((F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_TEXT))
    rows = short.orderBy(F.xxhash64("doc_id"), "text").limit(SAMPLE_DOCS)

    def serialise(batches):
        for batch in batches:
            for _, n, ids, offsets in encoded_slices(batch, path, end_id):
                raw = ids.astype(width)
                yield pa.RecordBatch.from_arrays([pa.array([raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())], names=["ids"])

    return train(sorted(r.ids for r in rows.mapInArrow(serialise, "ids binary").collect()))


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of all ``docs`` (columns doc_id, text) to ``folder``/files and the dictionary to ``folder``/dictionary.

    A text's ids are the library's (without special tokens added) and ``end_id``; a NULL or empty text has only that one.
    Documents go by ascending doc_id, NULL first; rows that share a doc_id are documents of their own, in the order they are
    read.  Documents of any length are whole, each in one frame of one file.  No rows give no files.  Other columns are
    ignored.  Rows of one doc_id may lie in several files, so no doc_id makes a file large.  The driver holds the sample.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or word_bpe_path()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    top = max(encoder(path).whole.get_vocab_size(with_added_tokens=True) - 1, end_id)
    width = "<u2" if top < 1 << 16 else "<u4"
    dictionary = sample_dictionary(docs, path, end_id, width)
    digest = _digest(dictionary)
    files = -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // file_bytes) or 1

    def compress(batches):
        zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True, write_dict_id=False)
        at, found = 0, []
        for batch in batches:
            for low, n, ids, offsets in encoded_slices(batch, path, end_id):
                if not found:
                    head = struct.pack(HEADER, MAGIC, np.dtype(width).itemsize, digest, TaskContext.get().partitionId())
                    at += len(head) + len(BREAK)
                    yield _block(head)
                raw = ids.astype(width)
                frames = [zstd.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                ends = np.cumsum([len(f) for f in frames])
                found.append((batch.column(0).slice(low, n), np.concatenate([[0], ends[:-1]]) + at, np.diff(offsets), at + ends))
                at += int(ends[-1]) + len(BREAK)
                yield _block(b"".join(frames))
        if found:
            index = _index(found)
            yield _block(index)
            sizes = np.concatenate([s for _, _, s, _ in found])
            yield _block(struct.pack(FOOTER, at, len(index), zlib.crc32(index), len(sizes), int(sizes.sum()), MAGIC))

    # the place in the input deals rows of one doc_id apart and keeps their order
    placed = docs.withColumn("place", F.monotonically_increasing_id())
    blocks = (placed.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "place")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place").drop("place").mapInArrow(compress, "block binary"))
    # a string column holds any bytes; the text writer writes them as they are
    blocks.select(F.col("block").cast("string").alias("block")).write.option("lineSep", "\n").text(f"{folder}/files")
    named = spark.createDataFrame([(bytearray(dictionary),)], "block binary").coalesce(1)
    named.select(F.col("block").cast("string").alias("block")).write.option("lineSep", "\n").text(f"{folder}/dictionary")


def _block(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["block"])


def _index(found: list[tuple]) -> bytes:
    ids = pa.concat_arrays([i for i, _, _, _ in found])
    arrays = [ids.fill_null(0).to_numpy().astype("<i8"), ids.is_valid().to_numpy(zero_copy_only=False).astype("<i8"),
              np.concatenate([s for _, s, _, _ in found]).astype("<i8"), np.concatenate([e for _, _, _, e in found]).astype("<i8"),
              np.concatenate([n for _, _, n, _ in found]).astype("<i8")]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(a.tobytes() for a in arrays))


class TokenFile:
    """One file, read piecewise through ``read(start, size)``; ``size`` is the file's.

    Raises ValueError when the file is not whole or was written with another dictionary.
    """

    def __init__(self, read: Callable[[int, int], bytes], size: int, dictionary: bytes) -> None:
        self.read = read
        magic, self.width, digest, self.number = struct.unpack(HEADER, read(0, struct.calcsize(HEADER)))
        place, length, crc, self.docs, self.tokens, end = struct.unpack(FOOTER, read(size - struct.calcsize(FOOTER) - len(BREAK), struct.calcsize(FOOTER)))
        index = read(place, length)
        if magic != MAGIC or end != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("no whole file of token ids")
        if digest != _digest(dictionary):
            raise ValueError("the file was written with another dictionary")
        self.ids, named, self.starts, self.ends, self.sizes = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), "<i8").reshape(5, -1)
        self.named = named.astype(bool)
        self.zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def raw(self, place: int) -> bytes:
        """The serialised ids of the file's document at ``place``; reads its frame alone."""
        return self.zstd.decompress(self.read(int(self.starts[place]), int(self.ends[place] - self.starts[place])))

    def document(self, place: int) -> np.ndarray:
        return np.frombuffer(self.raw(place), f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents of that id, by halving."""
        nulls = int(np.count_nonzero(~self.named))
        low, high = np.searchsorted(self.ids[nulls:], [doc_id, doc_id + 1])
        return list(range(nulls + int(low), nulls + int(high)))


def _bytes_reader(content: memoryview) -> Callable[[int, int], bytes]:
    return lambda start, size: bytes(content[start:start + size])


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    """The dictionary of ``folder``, empty for none."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/dictionary").select("content").collect()
    return bytes(max((r.content for r in rows), key=len))[:-len(BREAK)]


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """What the files of ``folder`` hold, per document: file (its number), place, doc_id, local_start, n_tokens, ids_crc32, ids.

    local_start counts the ids of the file's documents before it; ids (unsigned, little-endian, 32-bit) are left out
    on demand.  Files are read whole, by Spark; `TokenFile` reads single documents.
    """
    ship(spark)
    dictionary = read_dictionary(spark, folder)
    schema = "file long, place int, doc_id long, local_start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer()
                if not data.size:
                    continue
                file = TokenFile(_bytes_reader(memoryview(data)), data.size, dictionary)
                start = np.cumsum(file.sizes) - file.sizes
                for low in range(0, file.docs, 4096):
                    some = range(low, min(low + 4096, file.docs))
                    raw = [file.document(i).tobytes() for i in some]
                    if any(len(r) != 4 * n for r, n in zip(raw, file.sizes[low:])):
                        raise ValueError("a frame does not hold the ids that the index names")
                    cut = slice(low, some.stop)
                    arrays = [np.full(len(some), file.number), np.arange(low, some.stop, dtype=np.int32), pa.array(file.ids[cut], mask=~file.named[cut]),
                              start[cut], file.sizes[cut], pa.array([zlib.crc32(r) for r in raw], pa.int64())] + ([pa.array(raw, pa.binary())] if ids else [])
                    yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays],
                                                     names=[f.split()[0] for f in schema.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/files")
    return files.select("content").mapInArrow(read, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` of `read_tokens` with start: the ids of all documents before each.  The driver holds one number per file."""
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("file").agg(F.sum("n_tokens")).toLocalIterator())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])])
    starts = rows.sparkSession.createDataFrame([(f, int(b)) for (f, _), b in zip(sizes, before)], "file long, before long")
    return rows.join(F.broadcast(starts), "file").withColumn("start", F.col("before") + F.col("local_start")).drop("before", "local_start")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token-id files under the shared checkpoint folder and read back: doc_id, start, n_tokens, ids_crc32."""
    shared_checkpoints(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}")
    write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), folder.toString())
    rows = stable(read_tokens(spark, folder.toString(), ids=False))
    # what the query returns has its own checkpoint by now
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
