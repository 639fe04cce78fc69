"""Asking across a corpus which fingerprints several documents share.

Documents are dealt into batches of bounded size.  A batch sends its fingerprints, sorted and packed, one row
per range of fingerprint values; whoever holds a range sees all batches' fingerprints of it and sends each batch
one packed answer.  So a fingerprint costs a few bytes on the way instead of a row, a frequent one is sent once
per batch that has it, and the batch finds the answers beside its own texts.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import let_go, stable, store_of

#: Text bytes of a batch, on average.
BATCH_BYTES = 4 << 20
#: Fingerprints of a range, on average.
RANGE_PRINTS = 1_000_000


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers of one length; the first is sorted."""
    planes = [np.ascontiguousarray(np.diff(arrays[0], prepend=np.zeros(1, arrays[0].dtype)).view(np.uint8).reshape(-1, 8).T)]
    planes += [np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T) for a in arrays[1:]]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def unpack(data: bytes, count: int) -> list[np.ndarray]:
    """``count`` arrays of uint64 as they were packed."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    n = len(raw) // (8 * count)
    out = [np.ascontiguousarray(raw[8 * n * i:8 * n * (i + 1)].reshape(8, n).T).reshape(-1).view(np.uint64) for i in range(count)]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def range_of(prints: np.ndarray, ranges: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def compress_data(batches):
    """Rows (batch, id, data, row) with each text compressed: it crosses the network once and is read in every pass."""
    store_of("exchange")
    zstd = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data = [None if x is None else zstd.compress(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary()), batch.column(3)],
                                         names=batch.schema.names)


class Corpus:
    """Batches of documents: rows (batch, id, data, row) with the text's UTF-8 bytes, compressed, and the other columns.

    The batches are kept on the executors' disks while the object or a result of `finish` is in use; Spark makes a
    lost one anew.
    """

    def __init__(self, docs: DataFrame, carried: Column, prints_per_byte: float) -> None:
        """``prints_per_byte`` is about how many fingerprints a byte of text gives.

        ``docs`` should be read from files or a checkpoint: a partition that is made anew must have its rows in the same order.
        """
        spark = docs.sparkSession
        data = F.col("text").cast("binary")
        total = docs.agg(F.sum(F.octet_length(data))).first()[0] or 0
        self.batches = max(1, -(-total // BATCH_BYTES))
        self.ranges = max(1, int(total * prints_per_byte / RANGE_PRINTS) + 1)
        #: Leading bits of a fingerprint that tell nearly all different ones apart.
        self.bits = min(64, total.bit_length() + 8)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # dealt by place, so that rows which repeat one another go to different batches
        dealt = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(self.batches)).cast("int").alias("batch"),
                            F.col("doc_id").cast("long").alias("id"), data.alias("data"), carried.alias("row"))
        self.frame = dealt.mapInArrow(compress_data, dealt.schema).repartition(parts, "batch").persist(StorageLevel.DISK_ONLY)
        weakref.finalize(self, self.frame.unpersist)

    def ask(self, prints: Callable, answers: DataFrame | None, columns: int, reply: Callable, tag: int) -> DataFrame:
        """Answers (batch, tag, payload) to what each batch sends.

        ``prints(batch, replies)`` gives ``columns`` arrays, fingerprints first and sorted; ``reply(of, *arrays)`` gets
        those of all batches in a range (``of`` numbers the sender) and gives (places to answer, arrays of the answer).
        """
        ranges = self.ranges

        def send(batch, replies):
            let_go()
            got = prints(Batch(batch), replies)
            where = range_of(got[0], ranges)
            cuts = np.searchsorted(where, np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            number = batch["batch"][0].as_py() if batch.num_rows else 0
            return pa.table({"part": pa.array(some.astype(np.int32)), "batch": pa.array(np.full(len(some), number, dtype=np.int32)),
                             "payload": pa.array([pack(*(a[cuts[i]:cuts[i + 1]] for a in got)) for i in some], pa.binary())})

        def receive(table):
            let_go()
            sent = [unpack(p, columns) for p in table["payload"].to_pylist()]
            of = np.repeat(np.arange(len(sent)), [len(s[0]) for s in sent])
            places, out = reply(of, *(np.concatenate(x) for x in zip(*sent)))
            order = np.lexsort((out[0], of[places]))
            of, out = of[places][order], [a[order] for a in out]
            cuts = np.searchsorted(of, np.arange(len(sent) + 1))
            some = np.flatnonzero(np.diff(cuts))
            return pa.table({"batch": table["batch"].combine_chunks().take(pa.array(some)), "tag": pa.array(np.full(len(some), tag, dtype=np.int32)),
                             "payload": pa.array([pack(*(a[cuts[i]:cuts[i + 1]] for a in out)) for i in some], pa.binary())})

        sent = self._with(answers, send, "part int, batch int, payload binary")
        return stable(sent.groupBy("part").applyInArrow(receive, "batch int, tag int, payload binary"))

    def _with(self, answers: DataFrame | None, run: Callable, schema: str) -> DataFrame:
        mine = self.frame.groupBy("batch")
        if answers is None:
            return mine.applyInArrow(lambda batch: run(batch, {}), schema)

        def both(batch, replies):
            by_tag: dict[int, list[bytes]] = {}
            for t, p in zip(replies["tag"].to_pylist(), replies["payload"].to_pylist()):
                by_tag.setdefault(t, []).append(p)
            return run(batch, by_tag)

        return mine.cogroup(answers.groupBy("batch")).applyInArrow(both, schema)

    def finish(self, answers: DataFrame, removed: Callable) -> DataFrame:
        """Rows (row, data, n_bytes, n_removed, n_spans): every document without the bytes that ``removed(batch, replies)`` marks.

        data is NULL where the text was.
        """

        def run(table, replies):
            let_go()
            batch = Batch(table)
            gone = removed(batch, replies)
            cum = np.concatenate([[0], np.cumsum(gone)])
            kept = batch.data[~gone]
            ends = batch.off - cum[batch.off]
            begins = gone.copy()
            begins[1:] &= ~gone[:-1] | np.isin(np.arange(1, len(gone)), batch.off)
            spans = np.concatenate([[0], np.cumsum(begins)])[batch.off]
            data = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(kept)]).cast(pa.binary())
            nulls = table["data"].combine_chunks().is_null()
            data = pa.compute.if_else(nulls, pa.scalar(None, pa.binary()), data)
            return pa.table({"row": table["row"], "data": data, "n_bytes": pa.array(np.diff(batch.off)),
                             "n_removed": pa.array(np.diff(cum[batch.off])), "n_spans": pa.array(np.diff(spans))})

        row = self.frame.schema["row"].dataType.simpleString()
        out = self._with(answers, run, f"row {row}, data binary, n_bytes long, n_removed long, n_spans long")
        out._corpus = self
        return out


class Batch:
    """The documents of a batch as one stretch of bytes; document i is data[off[i]:off[i + 1]]."""

    def __init__(self, table: pa.Table) -> None:
        column = table["data"].combine_chunks() if table.num_rows else pa.array([], pa.binary())
        zstd = zstandard.ZstdDecompressor()
        rows = [b"" if x is None else zstd.decompress(x) for x in column.to_pylist()]
        self.data = np.frombuffer(b"".join(rows), dtype=np.uint8)
        self.off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        ids = table["id"].combine_chunks() if table.num_rows else pa.array([], pa.int64())
        #: Documents without an id neither own nor lose anything.
        self.named = ids.is_valid().to_numpy(zero_copy_only=False).astype(bool)
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, places, side="right") - 1


#: Ids as numbers that sort alike when unsigned.
def as_unsigned(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def first_owners(prints: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """Distinct fingerprints with the smallest id that has each, and 1 where several have it."""
    owner = as_unsigned(ids)
    order = np.lexsort((owner, prints))
    prints, owner = prints[order], owner[order]
    cuts = np.flatnonzero(np.diff(prints, prepend=np.uint64(0)) != 0) if len(prints) else np.zeros(0, dtype=np.int64)
    if len(prints) and (not len(cuts) or cuts[0]):
        cuts = np.concatenate([[0], cuts])
    last = np.append(cuts[1:], len(prints)) - 1
    return [prints[cuts], owner[cuts], (owner[cuts] != owner[last]).astype(np.uint64)] if len(prints) else [prints, owner, owner.copy()]


def owner_reply(of: np.ndarray, prints: np.ndarray, owner: np.ndarray, several: np.ndarray):
    """Answer with the smallest owner of all batches, to those that have another one too."""
    order = np.lexsort((owner, prints))
    group = np.concatenate([[True], prints[order][1:] != prints[order][:-1]])
    least = owner[order][np.flatnonzero(group)[np.cumsum(group) - 1]]
    tell = (least < owner[order]) | (several[order] > 0)
    return order[tell], [prints[order][tell], least[tell]]


def looked_up(replies: list[bytes], prints: np.ndarray) -> np.ndarray:
    """The smallest owner of each fingerprint as answered, the largest number for none."""
    out = np.full(len(prints), np.uint64(0xFFFFFFFFFFFFFFFF))
    got = [unpack(r, 2) for r in replies]
    if got and len(prints):
        keys, owners = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(keys)
        keys, owners = keys[order], owners[order]
        at = np.minimum(np.searchsorted(keys, prints), len(keys) - 1)
        hit = keys[at] == prints
        out[hit] = owners[at[hit]]
    return out
