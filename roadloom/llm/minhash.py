"""Near duplicates by MinHash with sequential Bayesian verification.

Documents with the same shingle set form a class; the rest works on one representative per class.  Bands of
the signature put representatives into buckets.  A candidate pair's signatures are compared batch by batch
and the pair goes as soon as the posterior probability of being similar enough falls below a chosen miss
probability; what is left is verified on the full shingle sets.

Every member of a bucket is compared with the bucket's smallest id first.  Only members of different components
are then still of interest: they are compared in blocks, all of them, and skipped when links found meanwhile
already join them.  So no pair of a bucket that could join two components goes unseen, and a bucket of near
copies of one text costs little more than its size.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadloom.llm.base import let_go, mix64, ship, slices, stable, store_of, table, word_codes
from roadloom.llm.components import components
from roadloom.llm.lattice import ranges

#: Bound of the probability that a similar pair shares no band, and of that that any look of the sequential test drops it.
MISS = 1e-6
BAND_ROWS = 4
#: Signature places compared before the posterior is looked at again.
BATCH = 16
#: Members of a bucket or hub that are compared in one piece.
BLOCK = 512
#: Different ids that are sent to all tasks at most; rows meet more of them in a shuffle.
SENT = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Documents are linked when ``share`` * intersection >= ``of`` * union of their sets of ``words``-word shingles."""

    words: int
    of: int
    share: int

    @property
    def threshold(self) -> float:
        return self.of / self.share

    @property
    def bands(self) -> int:
        return int(np.ceil(np.log(MISS) / np.log(1 - self.threshold**BAND_ROWS)))

    @property
    def hashes(self) -> int:
        return self.bands * BAND_ROWS

    def similar(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.share * common >= self.of * (a + b - common)

    @property
    def looks(self) -> list[int]:
        """Places compared at each look of the sequential test."""
        return [*range(BATCH, self.hashes, BATCH), self.hashes]

    def drop_chance(self, least: np.ndarray) -> float:
        """Probability that one of the looks drops a pair right at the threshold (a more similar pair: less)."""
        s, alive, seen, dropped = self.threshold, np.ones(1), 0, 0.0
        for n in self.looks:
            more = n - seen
            alive = np.convolve(alive, [comb(more, m) * s**m * (1 - s) ** (more - m) for m in range(more + 1)])
            dropped += alive[:least[n]].sum()
            alive[:least[n]] = 0.0
            seen = n
        return float(dropped)

    def least_matches(self) -> np.ndarray:
        """By places compared: fewest matches with which the posterior (uniform prior) of similarity is high enough.

        The bar is MISS shared by the looks, halved until all looks together drop a similar pair with MISS at most.
        """
        bar = MISS / len(self.looks)
        while self.drop_chance(least := self._least_matches(bar)) > MISS:
            bar /= 2
        return least

    def _least_matches(self, bar: float) -> np.ndarray:
        s = (np.arange(20_000) + 0.5) / 20_000
        over = s >= self.threshold
        out = np.zeros(self.hashes + 1, dtype=np.int64)
        for n in self.looks:
            for m in range(n + 1):
                logs = m * np.log(s) + (n - m) * np.log1p(-s)
                like = np.exp(logs - logs.max())
                if like[over].sum() >= bar * like.sum():
                    out[n] = m
                    break
        return out


CONTRACT = Rule(3, 85, 100)
#: Five words and 0.8: what near-duplicate stages take unless told otherwise.
USUAL = Rule(5, 80, 100)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct shingles as sorted 64-bit hashes.

    A text with fewer words than a shingle has its whole sequence as its only one, a text without words none.
    """
    codes, offsets, distinct = word_codes(texts, lower="ascii")
    if not len(codes):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in pc.cast(distinct, pa.large_binary()).to_pylist()), dtype=np.uint64, count=len(distinct))[codes]
    count = np.diff(offsets)
    take = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    start = ranges(offsets[:-1], take)
    size = np.repeat(np.minimum(count, words), take)
    out = mix64(size.astype(np.uint64))
    for k in range(words):
        with_k = size > k
        out[with_k] = mix64(out[with_k] * np.uint64(0x9E3779B97F4A7C15) + h[start[with_k] + k])
    doc = np.repeat(np.arange(len(texts)), take)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """MinHash signatures (texts x n, unsigned 32-bit); a text without shingles has zeros."""
    out = np.zeros((len(offsets) - 1, n), dtype=np.uint32)
    some = np.flatnonzero(np.diff(offsets) > 0)
    if len(some):
        factors = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
        for j in range(n):
            out[some, j] = np.minimum.reduceat(hashes * factors[j], offsets[some]) >> np.uint64(32)
    return out


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, digest (of the shingle set; NULL for an empty one), sig, for each row of ``docs`` (doc_id, text)."""
    hashes = rule.hashes

    def run(batches):
        store_of("minhash")
        for batch in batches:
            for low, high in slices(batch.column(1)):
                got, offsets = shingle_sets(batch.column(1).slice(low, high - low), rule.words)
                sig = signatures(got, offsets, hashes)
                raw, ends = got.tobytes(), (offsets * 8).tolist()
                digests = [xxhash.xxh3_128_digest(raw[a:b]) if b > a else None for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.diff(offsets)), pa.array(digests, pa.binary()),
                     pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc_id", "n_shingles", "digest", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, sig binary")


def as_matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), hashes)


def passes(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Pairs of signatures (row i of a and b) that survive the sequential test."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for at in range(0, a.shape[1], BATCH):
        to = min(at + BATCH, a.shape[1])
        matches[alive] += (a[alive, at:to] == b[alive, at:to]).sum(axis=1)
        alive = alive[matches[alive] >= least[to]]
    return alive


def band_rows(reps: DataFrame, rule: Rule) -> DataFrame:
    """(band, bucket, id): one row per band and representative."""
    keys = F.array(*[F.xxhash64(F.lit(j), F.substring("sig", 4 * BAND_ROWS * j + 1, 4 * BAND_ROWS)) for j in range(rule.bands)])
    return reps.select(F.posexplode(keys).alias("band", "bucket"), "id")


def by_sketch(pairs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose signatures pass the sequential test."""
    hashes, least = rule.hashes, rule.least_matches()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                fine = passes(as_matrix(batch.column(2), hashes), as_matrix(batch.column(3), hashes), least)
                yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(fine)) for i in (0, 1)], names=["a", "b"])

    left = reps.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def among(ids: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """``tables`` (id, ...), for inner joins with ``ids`` (one column, rows may repeat): without rows of other ids if the ids are few.

    Rows with texts or signatures that such a join would drop are then not shuffled for it.
    """
    wanted = stable(ids.toDF("wanted").distinct())
    if wanted.count() > SENT:
        return list(tables)
    return [t.join(F.broadcast(wanted), F.col("id") == F.col("wanted"), "left_semi") for t in tables]


def verify_hubs(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that are similar on their full shingle sets; ``texts`` has id, text.

    All b of one a are checked against it in pieces of about BLOCK, each with its own copy of a's text.
    """
    [texts] = among(pairs.select("a").unionAll(pairs.select("b")), texts)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("pieces"))
    members = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("piece"), "b", F.lit(1).alias("side"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("a").alias("b"), F.lit(0).alias("side"))
    rows = (members.unionAll(hubs).join(texts, F.col("b") == F.col("id")).select("a", "piece", "side", "b", "text")
            .repartition("a", "piece").sortWithinPartitions("a", "piece", "side", "b"))

    def run(batches):
        store_of("minhash")
        hub, hub_set = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for low, high in slices(batch.column(4)):
                part = batch.slice(low, high - low)
                a, piece, side, b = (part.column(i).to_numpy() for i in range(4))
                got, off = shingle_sets(part.column(4), rule.words)
                out_a, out_b = [], []
                cuts = np.flatnonzero((np.diff(a, prepend=a[0] - 1) != 0) | (np.diff(piece, prepend=piece[0]) != 0) | (side == 0))
                if not len(cuts) or cuts[0]:
                    cuts = np.concatenate([[0], cuts])
                for x, y in zip(cuts, np.append(cuts[1:], len(a))):
                    if side[x] == 0:
                        hub, hub_set = a[x], got[off[x]:off[x + 1]]
                        x += 1
                    if x == y or hub != a[x]:
                        continue
                    flat = got[off[x]:off[y]]
                    at = np.minimum(np.searchsorted(hub_set, flat), len(hub_set) - 1)
                    sums = np.concatenate([[0], np.cumsum(hub_set[at] == flat)])
                    common = sums[off[x + 1:y + 1] - off[x]] - sums[off[x:y] - off[x]]
                    fine = rule.similar(common, np.full(y - x, len(hub_set)), np.diff(off[x:y + 1]))
                    out_a.append(a[x:y][fine])
                    out_b.append(b[x:y][fine])
                if out_a:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One number per band of each signature; equal bands have equal numbers."""
    four = sig.reshape(len(sig), -1, BAND_ROWS).astype(np.uint64)
    out = np.zeros(four.shape[:2], dtype=np.uint64)
    for k in range(BAND_ROWS):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + four[:, :, k])
    return out


def joining_links(cell: dict, left: np.ndarray, right: np.ndarray, rule: Rule, least: np.ndarray) -> list[tuple[int, int]]:
    """Links between members ``left`` and ``right`` (places in the cell, the same or disjoint) that join components.

    A pair that shares an earlier band is left to that band's bucket.
    """
    ids, comp, sig, keys, sets, off = (cell[k] for k in ("ids", "comp", "sig", "keys", "sets", "off"))
    parent = {c: c for c in np.unique(comp).tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    same = left is right
    links = []
    for x in left.tolist():
        others = right[(comp[right] != comp[x]) & (right > x if same else True)]
        others = others[~(keys[others] == keys[x]).any(axis=1)]
        if not len(others):
            continue
        others = others[passes(np.broadcast_to(sig[x], (len(others), sig.shape[1])), sig[others], least)]
        mine_root = root(int(comp[x]))
        others = others[np.array([root(c) != mine_root for c in comp[others].tolist()], dtype=bool)]
        if not len(others):
            continue
        mine = sets[off[x]:off[x + 1]]
        size = off[others + 1] - off[others]
        flat = sets[ranges(off[others], size)]
        at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        sums = np.concatenate([[0], np.cumsum(mine[at] == flat)])
        ends = np.cumsum(size)
        common = sums[ends] - sums[ends - size]
        for y in others[rule.similar(common, np.full(len(others), len(mine)), size)].tolist():
            r, t = root(int(comp[x])), root(int(comp[y]))
            if r != t:
                parent[max(r, t)] = min(r, t)
                links.append((int(ids[x]), int(ids[y])))
    return links


def join_rest(buckets: DataFrame, reps: DataFrame, texts: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between members of one bucket that are still in different components.

    ``buckets`` (bucket, id, hub, n) are bucket rows, ``found`` (id, component) what the links to hubs gave.
    """
    least = rule.least_matches()
    hashes = rule.hashes
    known = buckets.filter("n > 2 AND id <> hub").join(found.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").select(
        "bucket", "band", "id", F.coalesce("component", "id").alias("component"))
    mixed = (known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m"))
             .filter("low <> high").select("bucket", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    members = stable(known.join(mixed, "bucket"))
    reps, texts = among(members.select("id"), reps, texts)
    cells = (members.withColumn("block", mine)
             .select("bucket", "band", "id", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "id", "component"))
    rows = (cells.join(reps.select(F.col("id").alias("rep"), "sig"), F.col("id") == F.col("rep")).drop("rep")
            .join(texts.withColumnRenamed("id", "t"), F.col("id") == F.col("t")).drop("t")
            .select("bucket", "i", "j", "band", "block", "id", "component", "sig", "text")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id"))

    def finish(kept):
        cell = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
        sig = as_matrix(cell.column(7), hashes)
        sets, off = shingle_sets(cell.column(8), rule.words)
        block, i, j = cell.column(4).to_numpy(), cell.column(1)[0].as_py(), cell.column(2)[0].as_py()
        parts = {"ids": cell.column(5).to_numpy(), "comp": cell.column(6).to_numpy(), "sig": sig, "sets": sets, "off": off,
                 "keys": band_keys(sig)[:, :cell.column(3)[0].as_py()]}
        left = np.flatnonzero(block == i)
        links = joining_links(parts, left, left if i == j else np.flatnonzero(block == j), rule, least)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

    def run(batches):
        store_of("minhash")
        kept, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
            for x, y in zip(cuts[:-1], cuts[1:]):
                now = tuple(k[:, x].tolist())
                if kept and now != key:
                    yield finish(kept)
                    kept = []
                    let_go()
                key = now
                kept.append(batch.slice(x, y - x))
        if kept:
            yield finish(kept)

    return rows.mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, rule: Rule = USUAL) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that can be reached over links (the own one included), kept is
    doc_id = component_id.  Words are runs without ASCII white space, A-Z in lower case; texts of any length are taken whole.  A NULL
    text or one without words has no shingles and is linked with nothing.  doc_id names a document: rows that repeat one with
    another text join what is reachable over either text, each row with its own n_shingles.  Rows without doc_id take no
    part: component_id NULL, kept true.  An empty table gives no rows.  A similar pair is missed with a probability below 2 * MISS.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    base = stable(sketches(docs, rule))
    full = base.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("id"))
    reps = stable(full.join(classes.select(F.col("digest").alias("d"), "id"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("id")))
                  .groupBy("id", "digest").agg(F.min("sig").alias("sig")).select("id", "sig"))
    rows = band_rows(reps, rule)
    sizes = rows.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    buckets = stable(rows.join(sizes, "bucket").select("bucket", "band", "id", "hub", "n"))
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    stars = buckets.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = verify_hubs(stable(by_sketch(stars, reps, rule)), texts, rule)
    # a doc_id with several texts is one document: it joins their classes
    several = full.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high").select("doc_id")
    theirs = stable(full.join(several, "doc_id", "left_semi").join(classes, "digest").select("doc_id", "id").distinct())
    least = theirs.groupBy("doc_id").agg(F.min("id").alias("a"))
    links = stable(links.unionByName(theirs.join(least, "doc_id").filter("a <> id").select("a", F.col("id").alias("b")).distinct()))
    found = components(links)
    more = join_rest(buckets, reps, texts, found, rule)
    joined = (more.join(found.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
              .join(found.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    last = components(joined)
    # a document's class, its component over links to hubs, and the component of that one
    step = found.select("id", F.col("component").alias("c1"))
    then = last.select(F.col("id").alias("l"), F.col("component").alias("c2"))
    placed = (full.select("doc_id", "digest").join(classes, "digest").join(step, "id", "left").withColumn("c1", F.coalesce("c1", "id"))
              .join(then, F.col("c1") == F.col("l"), "left").groupBy("doc_id").agg(F.min(F.coalesce("c2", "c1")).alias("component_id")))
    placed = placed.withColumnRenamed("doc_id", "placed_id")
    out = base.join(placed, F.col("doc_id") == F.col("placed_id"), "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near(docs: DataFrame, rule: Rule = USUAL) -> DataFrame:
    """``docs`` without near duplicates: of each component the document with the smallest doc_id stays.

    All columns are kept, whatever their names; rows without doc_id, words or text stay.  Texts of any length are
    compared on all their shingles.  Rows that share the doc_id that stays all stay; an empty table stays empty.
    """
    gone = stable(near_groups(docs.select("doc_id", "text"), rule).filter("NOT kept").select(F.col("doc_id").alias("gone")).distinct())
    if gone.count() <= SENT:  # else whole rows are shuffled to leave a few of them out
        gone = F.broadcast(gone)
    plain = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*plain).join(gone, F.col(plain[docs.columns.index("doc_id")]) == F.col("gone"), "left_anti").toDF(*docs.columns)


def op3_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents`` under CONTRACT; see `near_groups`."""
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), CONTRACT)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM w
), n AS (
  SELECT w.doc_id, CAST(count(s.g) AS BIGINT) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)
), r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a
)
SELECT r.doc_id, any_value(n.n) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM r JOIN n USING (doc_id) GROUP BY r.doc_id
"""
