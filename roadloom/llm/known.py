"""Places of strings that a Python worker has met, looked up for a whole column at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadloom.llm.base import dense, mix64

FACTOR = 0xD6E8FEB86659FD93


def flags(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


class Known:
    """Different strings in the order they were added, with how often each was asked for.

    They are found by 64-bit polynomial hashes of all strings of a column, kept sorted, and compared in full.
    """

    def __init__(self) -> None:
        self.bytes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.powers, self.inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.sorted, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.words)

    def hashes(self, words: pa.Array) -> np.ndarray:
        words = dense(words)
        if not len(words):
            return np.zeros(0, np.uint64)
        at = np.frombuffer(words.buffers()[1], dtype=np.int64)[:len(words) + 1]
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if at[-1] else np.zeros(0, np.uint8)
        if len(data) >= len(self.powers):
            for name, f in (("powers", FACTOR), ("inverses", pow(FACTOR, -1, 1 << 64))):
                out = np.full(2 * len(data), np.uint64(f))
                out[0] = 1
                setattr(self, name, np.cumprod(out, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.bytes[data] * self.powers[:len(data)], dtype=np.uint64)])
        return mix64((sums[at[1:]] - sums[at[:-1]]) * self.inverses[at[:-1]] + np.diff(at).astype(np.uint64))

    def find(self, words: pa.Array) -> np.ndarray:
        """Places of strings, -1 for those that were not added."""
        hashes = self.hashes(words)
        at = np.searchsorted(self.sorted, hashes)
        out = np.full(len(words), -1)
        left = np.arange(len(words))
        while len(left := left[at[left] < len(self.sorted)]) and len(left := left[self.sorted[at[left]] == hashes[left]]):
            place = self.order[at[left]]
            same = flags(pc.equal(self.words.take(pa.array(place)), words.take(pa.array(left))))
            out[left[same]] = place[same]
            left = left[~same]  # another string of this hash
            at[left] += 1
        return out

    def add(self, words: pa.Array) -> None:
        """Different strings, none of them added yet."""
        hashes = np.concatenate([self.sorted, self.hashes(words)])
        order = np.concatenate([self.order, np.arange(len(self.words), len(self.words) + len(words))])
        by_hash = np.argsort(hashes, kind="stable")
        self.sorted, self.order = hashes[by_hash], order[by_hash]
        self.words = pa.concat_arrays([self.words, words])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])

    def used(self, places: np.ndarray, times: np.ndarray) -> None:
        np.add.at(self.uses, places, times)

    def fewer(self, most: int, most_bytes: int) -> np.ndarray | None:
        """With more than ``most`` strings or bytes: keep the half used most, of these the short ones, and give their
        old places in order; else None."""
        if len(self.words) <= most and self.words.nbytes - 8 * len(self.words) <= most_bytes:
            return None
        order = np.argsort(-self.uses, kind="stable")[:most // 2]
        length = pc.binary_length(self.words).to_numpy(zero_copy_only=False)[order]
        by_length = np.argsort(length, kind="stable")
        order = np.sort(order[by_length[np.cumsum(length[by_length]) <= most_bytes // 2]])
        words, uses = self.words.take(pa.array(order)), self.uses[order] // 2
        self.clear()
        self.add(words)
        self.uses = uses
        return order
