"""Lattices of all segmentations of words over a fixed piece vocabulary, for many words at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadloom.llm.base import dense

#: The sign that stands for a space in the vocabulary.
SPACE = "▁"
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Characters worked on at once.
CHARS_AT_ONCE = 150_000


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i], ..., starts[i] + lengths[i] - 1 of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def in_order(*keys: np.ndarray) -> np.ndarray:
    """Places of the rows in ascending order of non-negative integer keys, first key first; alike rows stay in place.

    Keys and place are packed into one number where it holds them, as plain numbers are sorted much faster.
    """
    n = len(keys[0])
    bits, low = [int(k.max(initial=0)).bit_length() for k in keys], n.bit_length()
    if sum(bits) + low > 63:
        return np.lexsort(keys[::-1])
    packed = np.zeros(n, dtype=np.int64)
    for key, b in zip(keys, bits):
        packed = (packed << b) | key
    packed = (packed << low) | np.arange(n)
    packed.sort()
    return packed & ((1 << low) - 1)


class Pieces:
    """A SentencePiece vocabulary with byte fallback, looked up by hashes of character runs.

    Piece ids from ``size`` on stand for one character that the vocabulary spells in bytes: id - size is the
    code point.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.text: list[bytes] = [b""] * self.size
        self.scores = np.array([self.model.get_score(i) for i in range(self.size)])
        self.special = np.zeros(self.size, dtype=bool)
        places: dict[str, int] = {}
        for i in range(self.size):
            if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i):
                self.special[i] = True
            elif self.model.is_byte(i):
                value = int(self.model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.text[i] = bytes([value])
            else:
                places[self.model.id_to_piece(i)] = i
                self.text[i] = self.model.id_to_piece(i).replace(SPACE, " ").encode()
        self.longest = max(map(len, places))
        prefixes = sorted({p[:k] for p in places for k in range(1, len(p) + 1)})
        # the last one is for prefixes that were not found, whose place is -1
        self.piece_of = np.array([*(places.get(p, -1) for p in prefixes), -1], dtype=np.int64)
        keys = np.array([self._hash(p) for p in prefixes], dtype=np.uint64)
        self.keys, self.tables = keys, []
        left, bits = np.arange(len(keys)), 19
        while len(left):  # what finds its slot taken goes to the next, smaller table
            slots = self._slots(keys[left], bits)
            table = np.full(1 << bits, -1, dtype=np.int32)
            table[slots[::-1]] = left[::-1]
            self.tables.append((bits, table))
            left, bits = left[table[slots] != left], max(8, bits - 3)

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for ch in s:
            h = (h * int(HASH_STEP) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * bits) >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each hashed prefix, -1 for none."""
        found = np.full(len(keys), -1, dtype=np.int64)
        for n, (bits, table) in enumerate(self.tables):
            at = np.arange(len(keys)) if n == 0 else np.flatnonzero(found < 0)
            if not len(at):
                break
            got = table[self._slots(keys[at], bits)]
            good = (got >= 0) & (self.keys[got] == keys[at])
            found[at[good]] = got[good]
        return found

    def fallback(self, code_point: int, logp: np.ndarray) -> np.ndarray:
        """Log-probability of a character spelled in bytes."""
        return logp[self.byte_ids[list(chr(code_point).encode())]].sum(axis=0)

    def edge_logp(self, pieces: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Rows of ``logp`` (pieces x models) for piece ids, with byte-spelled characters worked out."""
        odd = pieces >= self.size
        out = logp[np.where(odd, 0, pieces)]
        if odd.any():
            points, back = np.unique(pieces[odd] - self.size, return_inverse=True)
            out[odd] = np.array([self.fallback(int(c), logp) for c in points])[back]
        return out


@dataclass
class Lattice:
    """Edges sorted by the node they end in; word w has the nodes first[w] ... first[w] + length[w]."""

    first: np.ndarray
    length: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    logp: np.ndarray
    alpha: np.ndarray


def build(pieces: Pieces, words: list[str] | pa.Array, logp: np.ndarray) -> Lattice:
    """Lattices of ``words`` and the forward sums over all segmentations (natural logs, per model)."""
    if isinstance(words, pa.Array):
        words = dense(words)
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        text = words.buffers()[2].to_pybytes().decode()
    else:
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = "".join(words)
    chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    stop = np.repeat(np.cumsum(length), length)
    place = np.arange(len(chars))
    word = np.repeat(np.arange(len(words)), length)
    starts, sizes, ids = [], [], []
    alive, h = place, np.zeros(len(chars), dtype=np.uint64)
    for size in range(1, pieces.longest + 1):
        fits = alive + size <= stop[alive]
        alive, h = alive[fits], h[fits]
        if not len(alive):
            break
        h = h * HASH_STEP + (chars[alive + size - 1] + 1).astype(np.uint64)
        found = pieces.find(h)
        piece = pieces.piece_of[found]
        if size == 1:
            piece = np.where(piece < 0, pieces.size + chars[alive], piece)
        hit = np.flatnonzero(piece >= 0)
        starts.append(alive[hit])
        sizes.append(np.full(len(hit), size))
        ids.append(piece[hit])
        going = np.flatnonzero(found >= 0)
        alive, h = alive[going], h[going]
    begin, size, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, sizes, ids))
    node = begin + word[begin] if len(begin) else begin  # each word has one node more than characters
    first = np.cumsum(length) - length + np.arange(len(words))
    depth = node + size - (first[word[begin]] if len(begin) else 0)
    order = in_order(depth, node + size)
    start, end, piece, depth = node[order], (node + size)[order], piece[order], depth[order]
    one = logp.shape[1] == 1  # plain rows of numbers are faster than those of one column
    weight = pieces.edge_logp(piece, logp[:, 0] if one else logp)
    alpha = np.full((int(length.sum()) + len(words), *weight.shape[1:]), -np.inf)
    alpha[first] = 0.0
    cuts = np.flatnonzero(np.diff(end, prepend=-1))  # the first edge of each node; alike depths lie together too
    runs = np.diff(np.append(cuts, len(end)))
    into = end[cuts]
    steps = np.flatnonzero(np.diff(depth[cuts], prepend=-1, append=-1))
    bounds = np.append(cuts, len(end))[steps]
    for x, y, a, b in zip(steps[:-1], steps[1:], bounds[:-1], bounds[1:]):
        value = alpha[start[a:b]] + weight[a:b]
        heads = cuts[x:y] - a
        top = np.maximum.reduceat(value, heads, axis=0)
        total = np.add.reduceat(np.exp(value - np.repeat(top, runs[x:y], axis=0)), heads, axis=0)
        alpha[into[x:y]] = top + np.log(total)
    if one:
        weight, alpha = weight[:, None], alpha[:, None]
    return Lattice(first, length, start, end, piece, weight, alpha)


def in_parts(words: list[str], limit: int = CHARS_AT_ONCE):
    """``words`` in lists of about ``limit`` characters."""
    part, size = [], 0
    for w in words:
        part.append(w)
        size += len(w)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]
