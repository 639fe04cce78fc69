"""SentencePiece encoding and decoding, and distinct sampled segmentations by Gumbel top-k.

The segmentations of a text into vocabulary pieces form a lattice.  Forward sums over it give exact conditional
probabilities for the last piece before every place, so a segmentation is drawn piece by piece.  Drawing several
without replacement is a best-first (A*) search for the largest perturbed log-probabilities: a branch of the
search tree is a set of segmentations, its bound is the exact maximum of their perturbed values, drawn from the
set's total probability and conditioned on the parent's maximum.  The k-th branch that is followed to its end is
the k-th sample.  A threshold, the best bound left over, gives each sample's inclusion probability.

No piece holds a space after another character, so texts fall into blocks that are lattices of their own; a
block is worked out once and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm import lattice
from roadloom.llm.base import dense, mix64, ship, slices, store_of, table
from roadloom.llm.known import Known
from roadloom.llm.lattice import SPACE, piece_model_path, ranges

SAMPLES = 3
SEED = 7
#: Exponent of a piece's probability: proportional to (merge rank + 2) ** -SHARPNESS.
SHARPNESS = 1.0
#: Blocks, and their bytes, whose lattices a Python worker keeps; beyond it the half that was used less goes.
KEPT_BLOCKS, KEPT_BYTES = 240_000, 4 << 20
#: Text bytes whose blocks are looked up at once, and whose segmentations are searched at once.
LOOK_UP, SLICE = 4 << 20, 512 << 10
MOST_EDGES = 16

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _times(constant: np.uint64, n: int) -> np.uint64:
    return np.uint64(int(constant) * n & 0xFFFFFFFFFFFFFFFF)


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from hashed uint64 keys."""
    z = mix64(x)
    z >>= np.uint64(11)
    u = z.astype(np.float64)
    u += 0.5
    u *= 2.0**-53
    return u


def piece_logp(pieces: lattice.Pieces, sharpness: float = SHARPNESS) -> np.ndarray:
    """Log-probabilities of all pieces by merge rank; byte pieces rank after all others (pieces x 1)."""
    rank = -pieces.scores.copy()
    normal = ~pieces.special
    normal[pieces.byte_ids] = False
    rank[pieces.byte_ids] = rank[normal].max() + 1
    weight = np.where(pieces.special, 0.0, (rank.clip(0, None) + 2.0) ** -sharpness)
    with np.errstate(divide="ignore"):
        return np.log(weight / weight.sum())[:, None]


class Grown:
    """An array that grows."""

    def __init__(self, dtype) -> None:
        self.data, self.n = np.zeros(1 << 12, dtype=dtype), 0

    def add(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


class Blocks:
    """Lattices of blocks, with the conditional probabilities of the edges into each node."""

    def __init__(self, path: str, sharpness: float) -> None:
        self.pieces = lattice.pieces(path)
        self.logp = piece_logp(self.pieces, sharpness)
        self.clear()

    def clear(self) -> None:
        self.known = Known()
        self.first, self.length, self.edge_from = Grown(np.int64), Grown(np.int64), Grown(np.int32)
        self.back, self.piece, self.cum = Grown(np.int32), Grown(np.int32), Grown(np.float64)
        #: Logs of an edge's conditional probability and of its alternatives' together (-inf for none).
        self.logq, self.other = Grown(np.float64), Grown(np.float64)
        self.edge_from.add(np.zeros(1, dtype=np.int64))

    def shrink(self) -> None:
        """Let the less used half of the blocks go when there are too many."""
        order = self.known.fewer(KEPT_BLOCKS, KEPT_BYTES)
        if order is None:
            return
        first, length = self.first.data[order], self.length.data[order]
        nodes = ranges(first, length + 1)
        count = self.edge_from.data[nodes + 1] - self.edge_from.data[nodes]
        edges = ranges(self.edge_from.data[nodes], count)
        kept = [(g, g.data[edges]) for g in (self.back, self.piece, self.cum, self.logq, self.other)]
        for grown, values in [*kept, (self.first, np.cumsum(length + 1) - length - 1), (self.length, length),
                              (self.edge_from, np.concatenate([[0], np.cumsum(count)]))]:
            grown.data[:len(values)], grown.n = values, len(values)  # the room is needed again

    def rows(self, blocks: pa.Array) -> np.ndarray:
        """Rows of blocks (strings with their leading space signs)."""
        got = self.known.find(blocks)
        unmet = got < 0
        if not unmet.any():
            return got
        unseen = blocks.filter(pa.array(unmet))
        missing = pc.unique(unseen)
        for low, high in slices(missing, lattice.CHARS_AT_ONCE, give_back=False):
            lat = lattice.build(self.pieces, missing.slice(low, high - low), self.logp)
            order = lattice.in_order(lat.end)
            start, end, alpha = lat.start[order], lat.end[order], lat.alpha[:, 0]
            logq = alpha[start] + lat.logp[:, 0][order] - alpha[end]
            # the likeliest edge of a node goes first, so that a draw mostly takes the first one it looks at
            cuts = np.flatnonzero(np.diff(end, prepend=-1))
            sizes = np.diff(np.append(cuts, len(order)))
            b = np.flatnonzero(logq == np.repeat(np.maximum.reduceat(logq, cuts), sizes))
            if len(b) > len(cuts):  # several alike: the first of them
                group = np.searchsorted(cuts, b, side="right") - 1
                b = b[np.diff(group, prepend=-1) != 0]
            a, b = cuts[b != cuts], b[b != cuts]
            for values in (order, start, logq):
                values[a], values[b] = values[b], values[a]
            q = np.exp(logq)
            count = np.bincount(end, minlength=len(lat.alpha))
            with np.errstate(divide="ignore"):
                other = np.log(np.where(np.repeat(sizes < 2, sizes), 0.0, np.maximum(1.0 - q, 1e-17)))
            cum = np.cumsum(q)
            cum -= np.repeat(cum[cuts] - q[cuts], sizes)
            cum[cuts + sizes - 1] = np.inf  # a draw never goes past a node's last edge
            nodes, edges = self.edge_from.n - 1, self.cum.n
            self.first.add(lat.first + nodes)
            self.length.add(lat.length)
            self.edge_from.add(edges + np.cumsum(count))
            for grown, values in ((self.back, end - start), (self.piece, lat.piece[order]), (self.cum, cum), (self.logq, logq), (self.other, other)):
                grown.add(values)
        self.known.add(missing)
        got[unmet] = self.known.find(unseen) if len(missing) < len(unseen) else np.arange(len(self.known) - len(missing), len(self.known))
        return got

    def draw(self, rows: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segmentations of the first ``at`` characters of blocks, from the back: (edges, places before them, edges per block)."""
        edge_from, cum, back = self.edge_from.data, self.cum.data, self.back.data
        who = np.flatnonzero(at > 0)
        t, key = at[who], keys[who]
        node = self.first.data[rows[who]] + t
        got, step = [], 0
        while len(who):
            u = unit(key + _times(_C, step + 1))
            e = edge_from[node].astype(np.int64)
            climb = np.flatnonzero(u >= cum[e])
            while len(climb):
                e[climb] += 1
                climb = climb[u[climb] >= cum[e[climb]]]
            got.append((who, e, t))
            width = back[e]
            t = t - width
            go = np.flatnonzero(t)
            node = node[go] - width[go]
            who, t, key = who[go], t[go], key[go]
            step += 1
        count = np.zeros(len(rows), dtype=np.int64)
        for k, (w, _, _) in enumerate(got):
            count[w] = k + 1
        before = np.cumsum(count) - count
        edges, places = np.zeros(int(count.sum()), dtype=np.int64), np.zeros(int(count.sum()), dtype=np.int64)
        for k, (w, e, at_e) in enumerate(got):
            to = before[w] + k
            edges[to] = e
            places[to] = at_e
        return edges, places, count


class Path:
    """One sample of every text: its edges in search order, and how soon the branches that leave it come.

    A branch's bound is -log(exp(-top) + exp(delay)), so of a text's branches the one of the smallest delay has the
    largest bound, and only that one's is worked out.
    """

    def __init__(self, store: Blocks, off, edge, place, block, top, own_from, rest, keys, r) -> None:
        """own_from: per text the first edge whose other branches are this path's own; rest: their probability there, NaN for 1 - q."""
        self.off, self.edge, self.place, self.block, self.top = off, edge, place, block, top
        n, sizes = len(edge), np.diff(off)
        total = np.concatenate([[0.0], np.cumsum(store.logq.data[edge])])
        self.logp = total[off[1:]] - total[off[:-1]]
        other = store.other.data[edge]
        has = (sizes > 0) & ~np.isnan(rest)
        with np.errstate(divide="ignore"):
            other[own_from[has]] = np.log(rest[has])
        seeds = keys + _times(_B, r) + np.uint64((1 << 40) + 1) - off[:-1].astype(np.uint64)
        noise = unit(np.repeat(seeds, sizes) + np.arange(n, dtype=np.uint64))
        np.log(np.negative(np.log(noise, out=noise), out=noise), out=noise)
        other += total[:-1] - np.repeat(total[off[:-1]], sizes)
        self.delay = np.subtract(noise, other, out=noise)
        self.delay[ranges(off[:-1], own_from - off[:-1])] = np.inf

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """(largest bound, its edge) per text; -inf for none."""
        docs = len(self.off) - 1
        value, where = np.full(docs, -np.inf), np.full(docs, -1)
        some = np.flatnonzero(np.diff(self.off) > 0)
        if len(some):
            least = np.full(docs, np.inf)
            least[some] = np.minimum.reduceat(self.delay, self.off[some])
            hit = np.flatnonzero(self.delay == np.repeat(least, np.diff(self.off)))
            doc = np.searchsorted(self.off, hit, side="right") - 1
            where[doc[::-1]] = hit[::-1]
            value = np.where(np.isposinf(least), -np.inf, -np.logaddexp(-self.top, least))
        return value, where


def sample_texts(store: Blocks, rows: np.ndarray, off: np.ndarray, keys: np.ndarray, k: int) -> tuple[list[Path], list[np.ndarray], np.ndarray]:
    """k distinct segmentations of each text, whose blocks are rows[off[i]:off[i + 1]].

    Returns the paths, per path which texts have it, and the best bound left over per text.  Texts without
    blocks have one segmentation, without pieces.
    """
    docs = len(off) - 1
    block_doc = np.repeat(np.arange(docs), np.diff(off))
    nth = (np.arange(len(rows)) - off[:-1][block_doc]).astype(np.uint64)
    edge, place, count = store.draw(rows, store.length.data[rows], mix64(keys[block_doc] + _A * (nth + np.uint64(1))))
    sums = np.concatenate([[0], np.cumsum(count)])
    path_off = sums[off]
    top = -np.log(-np.log(unit(keys + _B)))
    paths = [Path(store, path_off, edge, place, np.repeat(np.arange(len(rows)), count), top, path_off[:-1], np.full(docs, np.nan), keys, 1)]
    has = [np.ones(docs, dtype=bool)]
    taken = [np.full((docs, k), -1, dtype=np.int64)]  # edges used up where a path leaves its parent
    leave = [np.full(docs, -1, dtype=np.int64)]
    for r in range(2, k + 1):
        found = [p.best() for p in paths]
        value = np.stack([v for v, _ in found])
        parent = value.argmax(axis=0)
        top = value.max(axis=0)
        go = np.flatnonzero(top > -np.inf)
        at = np.stack([w for _, w in found])[parent, np.arange(docs)]
        e0, t0, b0, prefix = (np.zeros(docs, dtype=np.int64) for _ in range(4))
        used = np.full((docs, k), -1, dtype=np.int64)
        for j, p in enumerate(paths):
            d = go[parent[go] == j]
            e0[d], t0[d], b0[d], prefix[d] = p.edge[at[d]], p.place[at[d]], p.block[at[d]], at[d] - p.off[d]
            again = d[leave[j][d] == at[d]]
            used[again] = taken[j][again]
            p.delay[at[d]] = np.inf
        used[go, r - 2] = e0[go]
        node = store.first.data[rows[b0[go]]] + t0[go]
        options = store.edge_from.data[node][:, None] + np.arange(MOST_EDGES)
        open_ = options < store.edge_from.data[node + 1][:, None]
        for column in used[go].T:
            open_ &= options != column[:, None]
        options = np.where(open_, options, 0)
        weight = np.where(open_, np.exp(store.logq.data[options]), 0.0)
        cum = weight.cumsum(axis=1)
        pick = np.minimum((cum <= (unit(keys[go] + _times(_C, r)) * cum[:, -1])[:, None]).sum(axis=1), MOST_EDGES - 1)
        line = np.arange(len(go))
        new_edge, rest = options[line, pick], np.full(docs, np.nan)
        weight[line, pick] = 0.0
        rest[go] = weight.sum(axis=1)
        # the rest of the block where the path leaves its parent, then all later blocks
        later = off[1:][go] - b0[go] - 1
        item_block = ranges(b0[go], later + 1)
        item_doc = np.repeat(go, later + 1)
        head = np.cumsum(later + 1) - later - 1
        item_at = store.length.data[rows[item_block]].copy()
        item_at[head] = t0[go] - store.back.data[new_edge]
        item_key = mix64(keys[item_doc] + _A * (item_block - off[:-1][item_doc] + 1).astype(np.uint64) + _times(_B, r))
        edge, place, count = store.draw(rows[item_block], item_at, item_key)
        item_sums = np.concatenate([[0], np.cumsum(count)])
        tail = np.zeros(docs, dtype=np.int64)
        tail[go] = item_sums[np.append(head[1:], len(item_block))] - item_sums[head] if len(go) else 0
        size = np.zeros(docs, dtype=np.int64)
        size[go] = prefix[go] + 1 + tail[go]
        path_off = np.concatenate([[0], np.cumsum(size)])
        out = [np.zeros(int(path_off[-1]), dtype=np.int64) for _ in range(3)]
        for j, p in enumerate(paths):
            d = go[parent[go] == j]
            to, source = ranges(path_off[d], prefix[d]), ranges(p.off[d], prefix[d])
            for x, y in zip(out, (p.edge, p.place, p.block)):
                x[to] = y[source]
        mid = path_off[go] + prefix[go]
        to = ranges(mid + 1, tail[go])
        for x, y, z in zip(out, (new_edge, t0[go], b0[go]), (edge, place, np.repeat(item_block, count))):
            x[mid] = y
            x[to] = z
        own = path_off[:-1].copy()
        own[go] = mid
        paths.append(Path(store, path_off, *out, top, own, rest, keys, r))
        has.append(top > -np.inf)
        taken.append(np.where(np.arange(k) == r - 1, 0, used))
        taken[-1][go, r - 1] = new_edge
        taken[-1][:, r:] = -1
        leave.append(own)
    return paths, has, np.max([p.best()[0] for p in paths], axis=0)


def path_ids(store: Blocks, path: Path) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a path in reading order, with byte pieces for characters the vocabulary lacks."""
    n = len(path.edge)
    cuts = np.flatnonzero(np.diff(path.block, prepend=-1)) if n else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(cuts, n))
    back = np.repeat(2 * cuts + size - 1, size) - np.arange(n)
    got = store.piece.data[path.edge[back]] if n else np.zeros(0, dtype=np.int64)
    vocabulary, odd = store.pieces.size, np.flatnonzero(got >= store.pieces.size)
    if not len(odd):
        return got.astype(np.int32), path.off
    spelled = [store.pieces.byte_ids[list(chr(c - vocabulary).encode())] for c in got[odd].tolist()]
    sizes = np.array([len(s) for s in spelled])
    count = np.ones(n, dtype=np.int64)
    count[odd] = sizes
    more = np.concatenate([[0], np.cumsum(sizes - 1)])
    out = np.repeat(got.astype(np.int32, copy=False), count)
    out[ranges(odd + more[:-1], sizes)] = np.concatenate(spelled)
    return out, path.off + more[np.searchsorted(odd, path.off)]


_TEXTS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def decode_bytes(path: str, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of id sequences: their pieces' text in a row without the first space; control ids are empty."""
    if path not in _TEXTS:
        text = lattice.pieces(path).text
        size = np.array([len(t) for t in text], dtype=np.int64)
        _TEXTS[path] = (np.frombuffer(b"".join(text), dtype=np.uint8), np.concatenate([[0], np.cumsum(size)]))
    data, start = _TEXTS[path]
    size = (start[1:] - start[:-1])[ids]
    sums = np.concatenate([[0], np.cumsum(size)])
    out, ends = data[ranges(start[ids], size)], sums[off]
    full = np.flatnonzero(np.diff(ends) > 0)
    lead = ends[full][out[ends[full]] == 32] if len(full) else np.zeros(0, dtype=np.int64)
    return np.delete(out, lead), ends - np.searchsorted(lead, ends, side="left")


def blocks_of(store: Blocks, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, offsets): the blocks of each text in order."""
    texts = dense(pc.replace_substring(dense(texts), SPACE, " "))
    odd = pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  ")).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    off = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(int(off[0]), int(off[-1] - off[0])).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    off = off - off[0]
    empty = (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0)
    words = pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), coded.dictionary, pa.scalar("", pa.large_string()))
    # what stands beside a character that no piece holds starts a block of its own
    cut = np.flatnonzero(pc.match_substring_regex(words, "[\n\t]").to_numpy(zero_copy_only=False))
    whole = np.delete(np.arange(len(words)), cut)
    cut_parts = [_CUT.findall(w) for w in words.take(pa.array(cut)).to_pylist()]
    odd_at = np.flatnonzero(odd)
    odd_parts = [[b for w in regex.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+$", SPACE + t.replace(" ", SPACE)) for b in _CUT.findall(w)]
                 for t in texts.take(pa.array(odd_at)).to_pylist()]
    store.shrink()
    row = store.rows(pa.concat_arrays([words.take(pa.array(whole)), pa.array([b for parts in cut_parts + odd_parts for b in parts], pa.large_string())]))
    part_rows = row[len(whole):]
    in_cut = sum(map(len, cut_parts))
    count = np.ones(len(words), dtype=np.int64)
    count[cut] = [len(parts) for parts in cut_parts]
    begin = np.cumsum(count) - count
    flat = np.zeros(int(count.sum()), dtype=np.int64)
    flat[begin[whole]] = row[:len(whole)]
    flat[ranges(begin[cut], count[cut])] = part_rows[:in_cut]
    plain = ~(odd | empty)
    keep = np.repeat(plain, np.diff(off))
    used = codes[keep]
    store.known.used(flat, np.repeat(np.bincount(used, minlength=len(words)), count))
    rows = flat[ranges(begin[used], count[used])]
    sums = np.concatenate([[0], np.cumsum(np.where(keep, count[codes] if len(codes) else 0, 0))])
    out_off = sums[off]
    if len(odd_at):
        each = [rows[a:b] for a, b in zip(out_off[:-1], out_off[1:])]
        ends = in_cut + np.cumsum([len(parts) for parts in odd_parts])
        for i, parts, end in zip(odd_at, odd_parts, ends):
            each[i] = part_rows[end - len(parts):end]
        rows, out_off = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
    return rows, out_off


_CUT = regex.compile(r"[\n\t]|[^\n\t]+")


def sampled(docs: DataFrame, k: int = SAMPLES, seed: int = SEED, path: str | None = None, sharpness: float = SHARPNESS) -> DataFrame:
    """Up to ``k`` distinct segmentations of each whole text of ``docs`` (doc_id, text), drawn without replacement.

    Returns per sample: doc_id, sample (from 1, by falling perturbed log-probability), ids (binary, little-endian
    signed 32-bit), n_ids, log_prob (of the segmentation given the text), perturbed, log_inclusion (log of the
    probability that it is among the samples, given the threshold), round_trip (its decoded text is the text).
    The random numbers belong to (seed, doc_id), so a rerun gives the same samples.  A text with fewer than k
    segmentations gives all of them, an empty or NULL text one without ids.  Repeated rows give the same samples
    each, rows with a NULL doc_id are drawn by their place among NULL keys alike.  U+2581 counts as a space.
    """
    ship(docs.sparkSession)
    path = path or piece_model_path()

    def run(batches):
        kept, where = store_of("sampling"), (path, sharpness)
        if where not in kept:
            kept[where] = Blocks(path, sharpness)
        store = kept[where]
        for batch in batches:
            ids = pc.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for first, last in slices(batch.column(1), LOOK_UP):
                texts = dense(batch.column(1).slice(first, last - first))
                rows, off = blocks_of(store, texts)
                for a, b in slices(texts, SLICE, give_back=False):
                    low, high = first + a, first + b
                    part = dense(texts.slice(a, b - a))
                    found = sample_texts(store, rows[off[a]:off[b]], off[a:b + 1] - off[a], mix64(ids[low:high] * _A + np.uint64(seed)), k)
                    yield from written(batch.column(0).slice(low, high - low), part, *found)

    def written(doc_ids, part, paths, has, rest):
        """The samples of a slice, one batch per sample number."""
        store = store_of("sampling")[path, sharpness]
        size = pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        o = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
        raw = np.frombuffer(part.buffers()[2], dtype=np.uint8)[o[0]:o[-1]] if o[-1] > o[0] else np.zeros(0, np.uint8)
        for r, (p, there) in enumerate(zip(paths, has), 1):
            at = np.flatnonzero(there)
            if not len(at):
                continue
            got, got_off = path_ids(store, p)
            back, back_off = decode_bytes(path, got, got_off)
            same = np.diff(back_off) == size
            match = np.flatnonzero(same)
            wrong = back[ranges(back_off[match], size[match])] != raw[ranges(ends[match], size[match])]
            same[np.repeat(match, size[match])[wrong]] = False
            data = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(got_off * 4), pa.py_buffer(got)])
            with np.errstate(over="ignore", divide="ignore"):
                over = p.logp - rest  # far below the threshold the probability is its odds
                inclusion = np.where(over < -30, over, np.log(-np.expm1(-np.exp(np.maximum(over, -30)))))
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(take), pa.array(np.full(len(at), r, dtype=np.int32)), data.cast(pa.binary()).take(take),
                 pa.array(np.diff(got_off)[at]), pa.array(p.logp[at]), pa.array(p.top[at]), pa.array(inclusion[at]), pa.array(same[at])],
                names=["doc_id", "sample", "ids", "n_ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, sample int, ids binary, n_ids long, log_prob double, perturbed double, log_inclusion double, round_trip boolean")


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the library's own ids (binary, little-endian signed 32-bit) of each whole text; NULL is an empty text."""
    ship(docs.sparkSession)
    path = path or piece_model_path()

    def run(batches):
        model = lattice.pieces(path).model
        for batch in batches:
            got = model.encode(pc.fill_null(batch.column(1), "").to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array(g, dtype="<i4").tobytes() for g in got], pa.binary())],
                                             names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decoded(sequences: DataFrame, path: str | None = None) -> DataFrame:
    """``sequences`` (doc_id, ids as written by `sampled` or `encoded`) as doc_id, text.

    Bytes that are not UTF-8 become U+FFFD; NULL ids give a NULL text.
    """
    ship(sequences.sparkSession)
    path = path or piece_model_path()

    def run(batches):
        for batch in batches:
            rows = [b"" if x is None else x for x in batch.column(1).to_pylist()]
            ids = np.frombuffer(b"".join(rows), dtype="<i4")
            off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])])
            data, ends = decode_bytes(path, ids, off)
            data = data.tobytes()
            texts = [None if not ok else data[a:b].decode("utf-8", "replace")
                     for ok, a, b in zip(batch.column(1).is_valid().to_pylist(), ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return sequences.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def op4_gumbel_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three distinct sampled segmentations of every whole text of ``documents``, their ids as a crc32."""
    return sampled(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "sample", "n_ids", F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "log_inclusion", "round_trip")
