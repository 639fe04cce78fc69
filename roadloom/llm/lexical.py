"""Ranked lexical search over an inverted index, term at a time for short lists and document at a time for long ones.

The index is made of segments, each the postings of a bounded stretch of documents, written once without a shuffle.
A search first sums document frequencies over the segments, then ranks each segment's documents for each item.  The
item's short lists are summed into accumulators (term at a time); the accumulators then are one more list, with the
largest sum as its bound, beside the long lists.  Documents are taken in order from the lists that can still reach the
k-th best score, and the other lists are only looked into where the bounds leave a chance (document at a time).
A partition carries its best documents, and so its threshold, from segment to segment; the partitions' lists are
merged by a tree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import dense, ship, slices, stable, table, word_codes

K = 20
#: Text bytes of a segment.
SEGMENT_BYTES = 8 << 20
#: A list is short when it has at most one in so many of the segment's documents.
SHORT_SHARE = 16
#: Documents taken at once from the lists.
CHUNK = 512
#: Bytes of item texts searched for at once.
BLOCK_BYTES = 4 << 20
#: Partitions' lists that one merge step puts together.
FAN_IN = 16

LIST = "array<struct<neg:bigint,doc_id:bigint>>"
SEGMENT = "docs long, tokens long, ids binary, named binary, lengths binary, terms binary, starts binary, places binary, counts binary"

#: Letters, digits and all bytes of characters beyond ASCII stay, A-Z lower-cased; the rest separates terms.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, offsets, distinct terms) of whole texts, as `word_codes` has them for words."""
    texts = dense(texts)
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), texts
    buffers = texts.buffers()
    data = pa.py_buffer((buffers[2].to_pybytes() if buffers[2] is not None else b"").translate(_TERM_BYTES))
    return word_codes(pa.Array.from_buffers(pa.large_string(), len(texts), [None, buffers[1], data]), lower="none")


def _packed(a: np.ndarray) -> bytes:
    """The bytes of ``a`` with equal places of the numbers side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def _unpacked(data: bytes, dtype) -> np.ndarray:
    raw, size = zstandard.ZstdDecompressor().decompress(data), np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def segment(ids: pa.Array, texts: pa.Array) -> dict:
    """One index row: documents with a term, their lengths, and each term's postings in order of the documents."""
    codes, offsets, terms = term_codes(texts)
    lengths = np.diff(offsets)
    has = lengths > 0
    place = np.cumsum(has) - 1
    n = int(has.sum())
    keys, counts = np.unique(codes * max(n, 1) + np.repeat(place, lengths), return_counts=True)
    sizes = np.bincount(keys // max(n, 1), minlength=len(terms))
    used = sizes > 0  # the empty word of texts that begin or end with a separator is no term
    ids = ids.filter(pa.array(has)) if len(ids) else ids
    words = terms.filter(pa.array(used)).cast(pa.binary()).to_pylist() if len(terms) else []
    starts = np.concatenate([[0], np.cumsum(sizes[used])])
    # places as steps from the one before; a list's first is a place
    places = keys % max(n, 1)
    steps = np.diff(places, prepend=0)
    steps[starts[:-1]] = places[starts[:-1]]
    return {"docs": n, "tokens": int(lengths.sum()), "ids": _packed(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)),
            "named": _packed(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)), "lengths": _packed(lengths[has].astype(np.int64)),
            "terms": zstandard.ZstdCompressor(level=1).compress(b" ".join(words)), "starts": _packed(starts.astype(np.int64)),
            "places": _packed(steps.astype(np.uint32)), "counts": _packed(counts.astype(np.uint32))}


class Segment:
    """An index row as read back."""

    def __init__(self, row: dict) -> None:
        self.row, self.n = row, row["docs"]
        raw = zstandard.ZstdDecompressor().decompress(row["terms"])
        self.terms = pa.array(raw.split(b" ") if raw else [], pa.binary())
        self.starts = _unpacked(row["starts"], np.int64)

    def find(self, vocabulary: pa.Array) -> np.ndarray:
        """The place of each word in this segment's terms, -1 for none."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1)
        return pc.fill_null(pc.index_in(vocabulary, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def load(self) -> None:
        self.ids, self.named = _unpacked(self.row["ids"], np.int64), _unpacked(self.row["named"], np.uint8)
        self.lengths = _unpacked(self.row["lengths"], np.int64)
        self.steps, self.counts = _unpacked(self.row["places"], np.uint32), _unpacked(self.row["counts"], np.uint32)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.starts[term], self.starts[term + 1]
        return np.cumsum(self.steps[low:high], dtype=np.int64), self.counts[low:high].astype(np.int64)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index rows of ``docs`` (columns doc_id, text), kept in the shared checkpoint folder; nothing is shuffled.

    Terms are maximal runs of letters and digits of ASCII and of any characters beyond it, with A-Z lower-cased, of the
    whole text.  Documents without a term (NULL and empty texts too) are not in the index.  A very long text is a segment
    by itself.  Rows that repeat a doc_id are documents of their own; a NULL doc_id is kept.  Other columns are ignored.
    """
    ship(docs.sparkSession)

    def build(batches):
        for batch in batches:
            for low, high in slices(batch.column(1), segment_bytes):
                row = segment(batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low))
                if row["docs"]:
                    yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema([(f.split()[0], pa.int64() if f.split()[1] == "long" else pa.binary()) for f in SEGMENT.split(", ")])
    return stable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(build, SEGMENT))


class Ranking:
    """The best k documents of one item so far, best first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids, self.named = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    @property
    def least(self) -> int:
        """The score below which a document can't come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        scores, ids, named = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.named, named)))
        best = np.lexsort((ids, named, -scores))[:self.k]
        self.scores, self.ids, self.named = scores[best], ids[best], named[best]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: all postings of short lists summed up per document, in order of the documents."""
    places, gains = (np.concatenate(x) for x in zip(*lists))
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.diff(places, prepend=-1))
    return places[first], np.add.reduceat(gains[order], first)


def rank(lists: list[tuple[np.ndarray, np.ndarray]], found: Ranking, ids: np.ndarray, named: np.ndarray, chunk: int = CHUNK) -> int:
    """Document at a time over (places, gains): adds to ``found``, gives how many documents were looked at.

    Lists are kept by falling bound.  Those after which the rest's bounds sum up to less than the least score that
    still counts supply no documents, they are searched for the documents that the others supply.
    """
    bounds = np.array([int(g.max()) for _, g in lists], dtype=np.int64)
    order = np.argsort(-bounds, kind="stable")
    lists = [lists[i] for i in order]
    rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])
    at = [0] * len(lists)
    looked = 0
    while True:
        needed = int(np.searchsorted(-rest[:-1], -found.least, side="right"))  # lists from here on can't get there alone
        heads = [(i, lists[i][0][at[i]:at[i] + chunk]) for i in range(needed) if at[i] < len(lists[i][0])]
        if not heads:
            return looked
        # up to the first end of a chunk, so that no list has a document in between that isn't taken
        stop = min(int(h[-1]) for i, h in heads if at[i] + chunk < len(lists[i][0])) if any(at[i] + chunk < len(lists[i][0]) for i, _ in heads) else None
        parts = []
        for i, head in heads:
            cut = len(head) if stop is None else int(np.searchsorted(head, stop, side="right"))
            parts.append((head[:cut], lists[i][1][at[i]:at[i] + cut]))
            at[i] += cut
        places, scores = accumulate(parts)
        looked += len(places)
        for i in range(needed, len(lists)):
            chance = scores + rest[i] >= found.least
            places, scores = places[chance], scores[chance]
            if not len(places):
                break
            where = np.minimum(np.searchsorted(lists[i][0], places), len(lists[i][0]) - 1)
            scores = scores + np.where(lists[i][0][where] == places, lists[i][1][where], 0)
        fine = scores >= found.least
        if fine.any():
            found.add(scores[fine], ids[places[fine]], named[places[fine]])


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of the ``documents`` have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _norms(lengths: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    if 25 * int(lengths.max(initial=0)) * documents >= 2**63:
        return np.array([75 + 25 * int(x) * documents // tokens for x in lengths], dtype=np.int64)
    return 75 + 25 * lengths * documents // tokens


def _search_block(index: DataFrame, items: list[tuple], documents: int, tokens: int, k: int, short_share: int) -> DataFrame:
    """(item int, rank, doc_id, score) for the (distinct terms, repeats) of each item, numbered from 0."""
    words = sorted({w for terms, _ in items for w in terms})
    number = {w: i for i, w in enumerate(words)}
    wanted = [(np.array([number[w] for w in terms], dtype=np.int64), np.array(repeats, dtype=np.int64)) for terms, repeats in items]

    def frequencies(batches):
        vocabulary, total = pa.array(words, pa.binary()), np.zeros(len(words), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                part = Segment(row)
                at = part.find(vocabulary)
                has = at >= 0
                total[has] += part.starts[at[has] + 1] - part.starts[at[has]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    holding = np.zeros(len(words), np.int64)
    for term, df in index.select("terms", "starts", "docs").mapInArrow(frequencies, "term int, df long").groupBy("term").agg(F.sum("df")).toLocalIterator():
        holding[term] = df
    weights = np.array([weight(documents, int(x)) if x else 0 for x in holding], dtype=np.int64)

    def search(batches):
        vocabulary = pa.array(words, pa.binary())
        best = [Ranking(k) for _ in wanted]
        for batch in batches:
            for row in batch.to_pylist():
                part = Segment(row)
                part.load()
                norms = 12 * _norms(part.lengths, documents, tokens)
                at = part.find(vocabulary)
                lists = {}
                for term in np.flatnonzero((at >= 0) & (weights > 0)):
                    places, tf = part.postings(at[term])
                    lists[int(term)] = places, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + norms[places]))
                limit = part.n // short_share
                for found, (terms, repeats) in zip(best, wanted):
                    mine = [(lists[t][0], lists[t][1] if r == 1 else r * lists[t][1]) for t, r in zip(terms.tolist(), repeats.tolist()) if t in lists]
                    short = [x for x in mine if len(x[0]) <= limit]
                    mine = [x for x in mine if len(x[0]) > limit] + ([accumulate(short)] if short else [])
                    if mine:
                        rank(mine, found, part.ids, part.named)
        got = [i for i, b in enumerate(best) if len(b.scores)]
        lists = [[{"neg": ~int(s), "doc_id": int(d) if x else None} for s, d, x in zip(best[i].scores, best[i].ids, best[i].named)] for i in got]
        yield pa.RecordBatch.from_arrays(
            [pa.array(got, pa.int32()), pa.array([TaskContext.get().partitionId()] * len(got), pa.int64()),
             pa.array(lists, pa.list_(pa.struct([("neg", pa.int64()), ("doc_id", pa.int64())])))], names=["item", "node", "best"])

    lists = index.mapInArrow(search, f"item int, node bigint, best {LIST}")
    nodes = max(1, index.rdd.getNumPartitions())
    while True:  # neg is ~score, so ascending order is best first; a NULL id comes before others of its score
        nodes = -(-nodes // FAN_IN)
        lists = (lists.groupBy("item", F.expr(f"node div {FAN_IN}").alias("node"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best")))
        if nodes == 1:
            break
    return lists.select("item", F.posexplode("best").alias("at", "b")).select(
        "item", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.doc_id").alias("doc_id"), F.bitwise_not(F.col("b.neg")).alias("score"))


def search(index: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, short_share: int = SHORT_SHARE) -> DataFrame:
    """The k best documents of each item (columns item_id, text): item_id, rank int (from 1), doc_id, score, best first.

    Only scores above 0 count, equal ones go by ascending doc_id (a NULL doc_id first).  An item without terms, or
    whose terms no document has, gives no rows; so do an empty index and no items.  Of rows that share an item_id the
    one with the smallest text counts; NULL is an item_id like any other, a NULL text has no terms.  Items of any
    length are used whole.  The driver holds one block of item terms at a time, of about ``block_bytes`` of text.
    """
    spark = index.sparkSession
    ship(spark)
    items = items.groupBy("item_id").agg(F.min(F.col("text").cast("string")).alias("text"))
    total = index.agg(F.sum("docs"), F.sum("tokens")).first()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks if total[0] else 0):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").collect()
        codes, offsets, terms = term_codes(pa.array([r.text for r in rows], pa.string()))
        terms = terms.cast(pa.binary()).to_pylist()
        wanted = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            own, repeats = np.unique(codes[a:b], return_counts=True)
            wanted.append(([terms[c] for c in own], repeats.tolist()))
        if not any(w for w, _ in wanted):
            continue
        named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        found = _search_block(index, wanted, total[0], total[1], k, short_share)
        out = out.unionByName(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def op11_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all ``documents`` for each item of ``benchmark``."""
    index = build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return search(index, table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), "text"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), docs AS (
  SELECT row_number() OVER () AS place, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM docs
), postings AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs) GROUP BY place, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, total GROUP BY term, docs
), wanted AS (
  SELECT item_id, term, count(*) AS r
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (place), total
  GROUP BY item_id, place, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
