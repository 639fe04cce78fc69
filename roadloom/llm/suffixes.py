"""Repeated windows of D bytes, found by grouping fingerprints around anchors.

Two documents share a window of D bytes when two of their suffixes agree to depth D.  A depth-limited radix sort would
order all suffixes digit by digit; its first pass alone costs more than the disk budget (figures in the README), so no pass
here orders suffixes.  Instead only suffixes at anchors are looked at: in every window of D bytes the position whose
G-byte digit has the smallest hash.  Equal windows have equal anchors, so no repeated window is lost, and each pass
groups what the one before has left by the hash of a longer stretch:

* Pass 1 groups anchors by their first digit (G bytes) and keeps groups of several documents.
* Pass 2 groups those by the bytes that windows around the anchor can hold (D - G on either side).  Where all of
  them agree with a smaller document's, all windows around the anchor are repeated.
* Pass 3 goes on with groups whose surroundings differ.  A window reaches at least (D - G) / 2 bytes beyond the
  anchor's digit on one side, so a suffix stays only if the digit and that much on a side occur in several documents.
* Pass 4 takes what is left window by window to depth D.

Stretches are compared by hashes of at most 64 bits.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import mix64, ship, table
from roadloom.llm.exchange import Batch, Corpus, as_unsigned, first_owners, looked_up, owner_reply, unpack
from roadloom.llm.lattice import ranges

DEPTH = 50
DIGIT = 24
#: Bytes whose digits are hashed at once.
SEGMENT = 1 << 20

_K = [mix64(np.array([i + 1], dtype=np.uint64))[0] | np.uint64(1) for i in range(64)]


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))


def hash_at(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` (8 or more) bytes from the places ``at`` on."""
    steps = [*range(0, size - 7, 8)] + ([size - 8] if size % 8 else [])
    h = np.zeros(len(at), dtype=np.uint64)
    for i, step in enumerate(steps):
        h += mix64(words[at + step] ^ _K[i]) * _K[i + 16]
    return mix64(h)


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of values[i:i + width] for every i that has them."""
    have, out = 1, values
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return best(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(batch: Batch, depth: int, digit: int) -> np.ndarray:
    """Places whose digit has the smallest hash in some window of ``depth`` bytes of its document."""
    data, off = batch.data, batch.off
    n, span = len(data), depth - digit + 1
    whole = np.zeros(n, dtype=bool)  # a window starts here and ends in the same document
    size = np.diff(off)
    whole[ranges(off[:-1], np.maximum(size - depth + 1, 0))] = True
    found = []
    for low in range(0, n, SEGMENT):
        high = min(n, low + SEGMENT)
        a, b = max(0, low - span + 1), min(n, high + depth + 8)
        words = eights(data[a:b])
        count = min(high + span, n) - a  # digits that windows from a to high can hold
        if count <= 0:
            continue
        mixed = mix64(words ^ _K[0])
        far = np.zeros(len(words) + depth, dtype=np.uint64)
        far[:len(mixed)] = mixed
        digits = sum(far[s:s + count] * _K[i + 1] for i, s in enumerate([*range(0, digit - 7, 8)] + ([digit - 8] if digit % 8 else [])))
        value = (mix64(digits) >> np.uint64(32)).astype(np.uint32)
        value = np.maximum(value, 1)
        padded = np.concatenate([value, np.full(span - 1, 0xFFFFFFFF, dtype=np.uint32)])
        least = sliding(padded, span, np.minimum)  # by window start
        least[~whole[a:a + count]] = 0
        least = np.concatenate([np.zeros(span - 1, dtype=np.uint32), least])
        most = sliding(least, span, np.maximum)  # over the windows that hold each place
        at = np.flatnonzero(most == value) + a
        found.append(at[(at >= low) & (at < high)])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


class Windows:
    """Anchors of a batch with their first digit and their surroundings."""

    def __init__(self, batch: Batch, depth: int, digit: int) -> None:
        self.batch, self.depth, self.digit, self.side = batch, depth, digit, depth - digit
        self.words = eights(batch.data)
        at = anchors(batch, depth, digit)
        doc = batch.doc_of(at)
        named = batch.named[doc]
        self.at, self.doc = at[named], doc[named]
        self.first = hash_at(self.words, self.at, digit)

    def only(self, keep: np.ndarray) -> None:
        self.at, self.doc, self.first = self.at[keep], self.doc[keep], self.first[keep]

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of all bytes that windows around each anchor can hold."""
        off = self.batch.off
        return np.maximum(self.at - self.side, off[self.doc]), np.minimum(self.at + self.depth, off[self.doc + 1])

    def around(self) -> np.ndarray:
        """Hashes of the surroundings; those cut off by a document's edge count how far they reach."""
        begin, end = self.bounds()
        full = (self.at - begin == self.side) & (end - self.at == self.depth)
        out = np.zeros(len(self.at), dtype=np.uint64)
        x = self.at[full]
        out[full] = mix64(hash_at(self.words, x - self.side, self.depth) * _K[40] + hash_at(self.words, x, self.depth))
        raw = memoryview(self.batch.data)
        for i in np.flatnonzero(~full).tolist():
            out[i] = xxhash.xxh3_64_intdigest(raw[begin[i]:end[i]], seed=int(self.at[i] - begin[i]))
        return out


def known(replies: list[bytes], columns: int) -> list[np.ndarray]:
    got = [unpack(r, columns) for r in replies]
    return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, dtype=np.uint64)] * columns


def without_repeated_windows(docs: DataFrame, carried=None, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """Rows (row, data, n_bytes, n_removed, n_spans): each document without the bytes covered by a string of
    ``depth`` bytes that also starts in a document with a smaller doc_id.

    ``row`` is ``carried`` (the doc_id unless given), ``data`` the bytes left (NULL for a NULL text; a cut may fall inside
    a UTF-8 character).  Matches stay inside documents and are judged on the input.  Texts shorter than ``depth``
    lose nothing.  Rows without doc_id neither own nor lose anything; rows that share one do not take from
    each other.  Empty texts and tables are fine.  ``digit`` is between 8 and ``depth``.
    """
    ship(docs.sparkSession)
    corpus = Corpus(docs, F.col("doc_id") if carried is None else carried, 2 / (depth - digit + 2))
    # what the first two passes send is cut to the bits that matter; digits that only look alike fall out later
    lead, some = np.uint64(64 - corpus.bits), np.uint64(16)

    def first_digits(batch, _):
        w = Windows(batch, depth, digit)
        prints, _, several = first_owners(w.first >> lead << lead, batch.ids[w.doc])
        return [prints, several]

    def in_several(of, prints, several):
        values, back, count = np.unique(prints, return_inverse=True, return_counts=True)
        tell = np.flatnonzero(((count > 1) | (np.bincount(back, weights=several.astype(np.float64), minlength=len(values)) > 0))[back])
        return tell, [prints[tell]]

    def shared(batch, replies) -> Windows:
        w = Windows(batch, depth, digit)
        keys = np.sort(known(replies.get(1, []), 1)[0])
        first = w.first >> lead << lead
        at = np.minimum(np.searchsorted(keys, first), max(0, len(keys) - 1))
        w.only(keys[at] == first if len(keys) else np.zeros(len(w.at), dtype=bool))
        return w

    def surroundings(batch, replies):
        w = shared(batch, replies)
        first, around, owner = w.first >> lead << lead, w.around() >> some, as_unsigned(batch.ids[w.doc])
        order = np.lexsort((owner, around, first))
        first, around, owner = first[order], around[order], owner[order]
        new = np.ones(len(first), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (around[1:] != around[:-1])
        last = np.append(np.flatnonzero(new)[1:], len(new)) - 1 if len(new) else np.zeros(0, dtype=np.int64)
        return [first[new], around[new], owner[new], (owner[new] != owner[last]).astype(np.uint64)]

    def owners_around(of, first, around, owner, several):
        order = np.lexsort((owner, around, first))
        f, a, o = first[order], around[order], owner[order]
        new_f = np.concatenate([[True], f[1:] != f[:-1]])
        new = new_f | np.concatenate([[True], a[1:] != a[:-1]])
        least = o[np.flatnonzero(new)[np.cumsum(new) - 1]]
        group = np.cumsum(new_f) - 1
        differ = np.bincount(group, weights=new)[group] > 1
        tell = differ | (least < o) | (several[order] > 0)
        return order[tell], [mix64(f * _K[41] + a)[tell], least[tell], differ[tell].astype(np.uint64)]

    def placed(batch, replies):
        """(anchors, owner of the same surroundings, whether the digit has others too)."""
        keys, owners, differ = known(replies.get(2, []), 3)
        order = np.argsort(keys)
        keys, owners, differ = keys[order], owners[order], differ[order]
        w = Windows(batch, depth, digit)
        key = mix64((w.first >> lead << lead) * _K[41] + (w.around() >> some)) if len(keys) else np.zeros(len(w.at), dtype=np.uint64)
        at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
        hit = keys[at] == key if len(keys) else np.zeros(len(w.at), dtype=bool)
        w.only(hit)
        return w, owners[at[hit]] if len(keys) else owners, differ[at[hit]] > 0 if len(keys) else differ > 0

    half = -(-(depth - digit) // 2)

    def one_sided(w: Windows, owner: np.ndarray, differ: np.ndarray):
        """Anchors that own their surroundings in groups with others, and hashes of the digit with the bytes before
        or after it; with whether the document has those bytes."""
        off = w.batch.off
        mine = np.flatnonzero((owner == as_unsigned(w.batch.ids[w.doc])) & differ)
        at, doc = w.at[mine], w.doc[mine]
        fits = at - half >= off[doc], at + digit + half <= off[doc + 1]
        prints = [np.zeros(len(mine), dtype=np.uint64) for _ in fits]
        for k, (ok, start) in enumerate(zip(fits, (at - half, at))):
            prints[k][ok] = mix64(hash_at(w.words, start[ok], digit + half) + np.uint64(k)) >> lead << lead
        return mine, prints, fits

    def sides(batch, replies):
        w, owner, differ = placed(batch, replies)
        mine, prints, fits = one_sided(w, owner, differ)
        ids = batch.ids[w.doc[mine]]
        found, _, several = first_owners(np.concatenate([p[ok] for p, ok in zip(prints, fits)]), np.concatenate([ids[ok] for ok in fits]))
        return [found, several]

    def single(w: Windows, owner: np.ndarray, differ: np.ndarray, replies) -> tuple[np.ndarray, np.ndarray]:
        """(starts, documents) of the windows that are looked at one by one."""
        mine, prints, fits = one_sided(w, owner, differ)
        keys = np.sort(known(replies.get(3, []), 1)[0])
        begin, end = w.bounds()
        first, last = begin[mine], end[mine] - depth
        at = w.at[mine]
        starts, docs = [], []
        for p, ok, low, high in zip(prints, fits, (first, np.maximum(first, at - (depth - digit) + half)), (np.minimum(last, at - half), last)):
            place = np.minimum(np.searchsorted(keys, p), max(0, len(keys) - 1))
            hit = ok & (keys[place] == p) if len(keys) else np.zeros(len(mine), dtype=bool)
            count = np.maximum(high[hit] - low[hit] + 1, 0)
            starts.append(ranges(low[hit], count))
            docs.append(np.repeat(w.doc[mine][hit], count))
        start, place = np.unique(np.concatenate(starts), return_index=True)
        return start, np.concatenate(docs)[place]

    def windows(batch, replies):
        w, owner, differ = placed(batch, replies)
        start, doc = single(w, owner, differ, replies)
        return first_owners(hash_at(w.words, start, depth), batch.ids[doc])

    def removed(batch, replies):
        w, owner, differ = placed(batch, replies)
        mine = as_unsigned(batch.ids[w.doc])
        begin, end = w.bounds()
        whole = owner < mine
        start, doc = single(w, owner, differ, replies)
        hit = looked_up(replies.get(4, []), hash_at(w.words, start, depth)) < as_unsigned(batch.ids[doc])
        edge = np.zeros(len(batch.data) + 1, dtype=np.int32)
        np.add.at(edge, np.concatenate([begin[whole], start[hit]]), 1)
        np.add.at(edge, np.concatenate([end[whole], start[hit] + depth]), -1)
        return np.cumsum(edge[:-1]) > 0

    one = corpus.ask(first_digits, None, 2, in_several, 1)
    two = corpus.ask(surroundings, one, 4, owners_around, 2)
    three = corpus.ask(sides, two, 2, in_several, 3)
    four = corpus.ask(windows, two.unionAll(three), 3, owner_reply, 4)
    return corpus.finish(two.unionAll(three).unionAll(four), removed)


def op10_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without bytes of 50-byte strings that an earlier document has."""
    out = without_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    told = out.select(F.col("row").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      F.sha2(F.coalesce("data", F.lit("").cast("binary")), 256).alias("kept_sha256"))
    told._source = out
    return told
