"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Target of text bytes worked on at once inside a task.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of ``sf_dir``, read by Spark alone (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The folder of the driver need not be on the workers' path, so the package goes with Spark's own file
    distribution (``addPyFile``).
    """
    sc = spark.sparkContext
    if getattr(sc, "_roadloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="roadloom-"), "roadloom_workers.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._roadloom_shipped = True


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; only a local master may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="roadloom-checkpoints-")
        sc.setCheckpointDir(named)


def stable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that later passes see the same rows in the same partitions."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def crc32_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as decimal text (NULL for a NULL id)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary"))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the rows that no model learns from: crc32(doc_id as text) mod 4 is 2 (a NULL id counts as held out)."""
    return F.coalesce(crc32_of_id(doc_id) % 4 == 2, F.lit(True))


_STORES: dict[str, dict] = {}


def store_of(operator: str) -> dict:
    """What a Python worker keeps for an operator between batches.  Workers go on to other operators, so what they
    keep for another one goes first."""
    for other in [o for o in _STORES if o != operator]:
        del _STORES[other]
    return _STORES.setdefault(operator, {})


def let_go() -> None:
    """Give memory that is no longer used back to the system: a worker shares its executor's limit with others."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None


def slices(column: pa.Array, limit: int = SLICE_BYTES, give_back: bool = True):
    """Consecutive (start, stop) row ranges of a string column of about ``limit`` bytes, one row at least.

    After each, unused memory goes back to the system; without ``give_back`` it is left for the next slice.
    """
    n = len(column)
    if not n:
        return
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < n:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, min(stop, n)
        start = min(stop, n)
        if give_back:
            let_go()


def dense(texts: pa.Array) -> pa.Array:
    """Texts as an array that starts at the start of its buffers, NULL as an empty text.

    Some string functions of the library go wrong on slices; they get these.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.large_string())
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(int(at[0]), int(at[-1] - at[0])) if data is not None else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(at - at[0])), data])


def word_codes(texts: pa.Array, lower: str = "ascii") -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, offsets, distinct words) of the white-space separated words of each text.

    ``codes[offsets[i]:offsets[i + 1]]`` are text i's words as places in the distinct words.  White space is
    space and ``\\t\\n\\v\\f\\r``; ``lower`` is "ascii" (A-Z only), "utf8" or "none".  NULL is an empty text.
    """
    texts = dense(texts)
    if lower == "ascii":
        texts = pc.ascii_lower(texts)
    elif lower == "utf8":
        texts = pc.utf8_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:  # from white space at either end of a text
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return codes, offsets, coded.dictionary


def mix64(z: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on arrays of uint64."""
    z = z ^ (z >> np.uint64(30))
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z
