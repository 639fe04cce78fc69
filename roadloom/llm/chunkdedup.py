"""Substring deduplication by content-defined chunks of a gear rolling hash.

A text is cut where the rolling hash of its last bytes says so, so an insertion moves a few cuts around it and no
others.  Chunks are compared by digest; a chunk that also occurs in a document with a smaller id is a copy, and
runs of copies long enough to be a passage are taken out.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import mix64, ship, table
from roadloom.llm.exchange import Batch, Corpus, as_unsigned, first_owners, looked_up, owner_reply
from roadloom.llm.lattice import ranges

#: A cut where the top bits of the hash of the last 16 bytes are zero, no such place in the LEAST bytes before it;
#: chunks have at most MOST bytes.  They have about 33 on average.
CUT_BITS, LEAST, MOST = 4, 12, 128
#: Bytes of consecutive copied chunks that are taken out; a passage of 50 words has about three times as many.
RUN_BYTES = 80

_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte of it and the 15 bytes before, each older byte shifted one further."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    return h


def cut_places(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ends of all chunks of the documents data[off[i]:off[i + 1]]; never inside a UTF-8 character."""
    starts = off[:-1][np.diff(off) > 0]
    begins = (data & 0xC0) != 0x80
    place = np.flatnonzero(gear(data) >> np.uint16(16 - CUT_BITS) == 0) + 1
    place = place[place < len(data)]
    place = place[begins[place]]
    doc_start = starts[np.searchsorted(starts, place, side="right") - 1] if len(place) else place
    place, doc_start = place[place - doc_start >= LEAST], doc_start[place - doc_start >= LEAST]
    before = np.concatenate([[-LEAST], place[:-1]])
    place = place[place - np.maximum(before, doc_start) >= LEAST]
    place = np.union1d(place, off[1:][np.diff(off) > 0])
    begin = np.concatenate([[0], place[:-1]])
    forced = (place - begin - 1) // MOST
    more = np.repeat(begin, forced) + MOST * (ranges(np.ones(len(forced), dtype=np.int64), forced))
    for _ in range(3):
        inside = ~begins[more]
        more[inside] -= 1
    return np.union1d(place, more)


def chunked(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, digest) of every chunk."""
    end = cut_places(batch.data, batch.off) if len(batch.data) else np.zeros(0, dtype=np.int64)
    begin = np.concatenate([[0], end[:-1]]).astype(np.int64) if len(end) else end
    raw = memoryview(batch.data)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())), dtype=np.uint64, count=len(end))
    return begin, end, digest


def neighbours(digest: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests of chunk pairs that stand side by side in a document, place of the left one)."""
    left = np.flatnonzero(doc[1:] == doc[:-1])
    return mix64(digest[left] * np.uint64(0x9E3779B97F4A7C15) + digest[left + 1] + np.uint64(1)), left


def without_repeats(docs: DataFrame, carried=None, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Rows (row, data, n_bytes, n_removed, n_spans): each document without passages that an earlier one has.

    ``row`` is ``carried`` (the doc_id unless given), ``data`` the UTF-8 bytes left (NULL for a NULL text).  A chunk is a
    copy when its digest also occurs in a document with a smaller doc_id, and a run of copies goes on from one to the
    next when these two also stand side by side in a document with a smaller doc_id: chunks that are common each
    for itself do not add up to a passage.  Runs of at least ``run_bytes`` bytes are removed, judged on the input.  So the
    first document keeps a passage, and repeats inside one document stay.  Rows without doc_id neither own nor lose passages;
    rows that share a doc_id do not take from each other.  Texts of any length are taken whole; empty texts and tables are fine.
    """
    ship(docs.sparkSession)
    corpus = Corpus(docs, F.col("doc_id") if carried is None else carried, 1 / 15)

    def prints(batch, _):
        begin, _, digest = chunked(batch)
        doc = batch.doc_of(begin)
        pairs, left = neighbours(digest, doc)
        digest, doc = np.concatenate([digest, pairs]), np.concatenate([doc, doc[left]])
        named = batch.named[doc]
        return first_owners(digest[named], batch.ids[doc[named]])

    def removed(batch, replies):
        begin, end, digest = chunked(batch)
        gone = np.zeros(len(batch.data), dtype=bool)
        if not len(begin):
            return gone
        doc = batch.doc_of(begin)
        pairs, left = neighbours(digest, doc)
        mine = as_unsigned(batch.ids[doc])
        owner = looked_up(replies.get(1, []), np.concatenate([digest, pairs]))
        copy = batch.named[doc] & (owner[:len(digest)] < mine)
        joined = np.zeros(len(digest) + 1, dtype=bool)  # chunk i - 1 with chunk i
        joined[left + 1] = copy[left] & copy[left + 1] & (owner[len(digest):] < mine[left])
        first, last = np.flatnonzero(copy & ~joined[:-1]), np.flatnonzero(copy & ~joined[1:])
        x, y = begin[first], end[last]
        long = y - x >= run_bytes
        gone[ranges(x[long], (y - x)[long])] = True
        return gone

    return corpus.finish(corpus.ask(prints, None, 3, owner_reply, 1), removed)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of `without_repeats` and all other columns as they are."""
    others = [c for c in docs.columns if c != "text"]
    plain = {c: f"c{i}" for i, c in enumerate(others)}  # any column name is fine
    out = without_repeats(docs, F.struct(*[F.col(f"`{c}`").alias(p) for c, p in plain.items()]))
    kept = out.select(*[F.decode("data", "UTF-8").alias("text") if c == "text" else F.col("row").getField(plain[c]).alias(c) for c in docs.columns])
    kept._source = out
    return kept


def op2_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without repeated passages: bytes and spans removed, and the sha256 of what is left."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    told = out.select(F.col("row").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      F.sha2(F.coalesce("data", F.lit("").cast("binary")), 256).alias("kept_sha256"))
    told._source = out
    return told
