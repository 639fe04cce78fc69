"""Ids of whole texts for the public lower-casing word BPE vocabulary, with each distinct word encoded once.

White space always ends a token there, so a text's ids are its words' ids in a row, and the library is asked for
words.  A word of characters below U+0300 is lower-cased and split here as the vocabulary file says, and its parts are
encoded many at once; any other word, and one that holds a special token's string, is encoded by the library as it is.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadloom.llm.base import store_of, word_codes
from roadloom.llm.known import Known, flags

#: Words, and their bytes, that a Python worker keeps; beyond it the half that was used less goes.
KEPT_WORDS, KEPT_BYTES = 400_000, 8 << 20
#: Words encoded in one call.
PART_WORDS = 2000

#: How the vocabulary file's pre-tokenizer splits text.
SPLIT = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
#: Characters whose normal form, lower case or class is left to the library.
ODD = "[^\\x00-\\x1b\\x20-\\x84\\x86-\\x{12f}\\x{131}-\\x{2ff}]"
NO_BREAK_SPACE = "\u00a0"


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def distinct(*columns: pa.Array) -> pa.Array:
    """The different values of string columns, in order of appearance."""
    return pc.unique(pa.concat_arrays(columns))


class WordEncoder:
    """Encodes texts as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        spaces = pre_tokenizers.WhitespaceSplit()
        # printable ASCII is its own byte alphabet
        self.ascii, self.parts = Tokenizer(self.whole.model), Tokenizer(self.whole.model)
        self.ascii.pre_tokenizer = spaces
        self.parts.pre_tokenizer = pre_tokenizers.Sequence([spaces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        special = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = "|".join([ODD, *special])
        self.known = Known()
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of texts as they are."""
        each = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in each for i in ids], dtype=np.uint32), np.fromiter(map(len, each), dtype=np.int64, count=len(each))

    def encode_parts(self, parts: pa.Array, encoder) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of parts: no white space, one match of SPLIT each."""
        out = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for at in range(0, len(parts), PART_WORDS):
            some = parts.slice(at, PART_WORDS)
            got = encoder.encode_batch_fast([" ".join(some.to_pylist())], add_special_tokens=False)[0].ids
            ids = np.fromiter(got, dtype=np.uint32, count=len(got))
            stops = np.flatnonzero(self.last[ids]) + 1
            # else there is a token that only looks like a word's last one
            out.append((ids, np.diff(stops, prepend=0)) if len(stops) == len(some) else self.by_library(some.to_pylist()))
        return tuple(np.concatenate(x) for x in zip(*out))

    def keep(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add different words that are not kept yet."""
        self.known.add(words)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of kept words in a row."""
        sums = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.starts[places] - sums[:-1], sizes) + np.arange(sums[-1])]

    def sizes(self, places: np.ndarray) -> np.ndarray:
        return self.starts[places + 1] - self.starts[places]

    def add(self, words: pa.Array) -> None:
        """Keep usual words in lower case, none of them kept yet, by way of their parts."""
        alone = flags(pc.utf8_is_alpha(words))
        mixed = words.filter(pa.array(~alone))
        spaced = pc.replace_substring_regex(pc.replace_substring(mixed, NO_BREAK_SPACE, " "), SPLIT, r"\1 ")
        lists = pc.ascii_split_whitespace(spaced)
        flat, ends = lists.values, lists.offsets.to_numpy().astype(np.int64)
        full = flags(pc.not_equal(pc.binary_length(flat), 0))
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        flat = flat.filter(pa.array(full))
        new = distinct(words.filter(pa.array(alone)), flat)
        new = new.filter(pa.array(self.known.find(new) < 0))
        plain = flags(pc.match_substring_regex(new, "^[!-~]+$"))
        for some, encoder in ((new.filter(pa.array(plain)), self.ascii), (new.filter(pa.array(~plain)), self.parts)):
            self.keep(some, *self.encode_parts(some, encoder))
        # a word that is its only part is kept by now
        rest = self.known.find(mixed) < 0
        own = self.known.find(flat)
        own = own[np.repeat(rest, np.diff(ends))]
        sizes = self.sizes(own)
        sums = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(np.diff(ends)[rest])])]
        self.keep(mixed.filter(pa.array(rest)), self.gather(own, sizes), np.diff(sums))

    def shrink(self) -> None:
        """Let the less used half of the words go when there are too many, and the longest when they are too long."""
        order = self.known.fewer(KEPT_WORDS, KEPT_BYTES)
        if order is not None:
            sizes = self.sizes(order)
            self.ids = self.gather(order, sizes)
            self.starts = np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i's ids are ids[offsets[i]:offsets[i + 1]]; NULL is an empty text."""
        codes, offsets, words = word_codes(texts, lower="none")
        if not len(codes):
            return np.zeros(0, np.uint32), offsets
        self.shrink()
        odd = pc.match_substring_regex(words, self.odd)
        # an odd word stands in the store as in the text, marked apart from lower-cased words
        lower = pc.utf8_lower(words)
        space = pa.scalar(" ", words.type)
        words = pc.if_else(odd, pc.binary_join_element_wise(space, words, pa.scalar("", words.type)), lower) if flags(odd).any() else lower
        known = self.known.find(words)
        if (known < 0).any():
            missing = distinct(words.filter(pa.array(known < 0)))
            strange = pc.starts_with(missing, " ")
            self.add(missing.filter(pc.invert(strange)))
            if len(rest := missing.filter(strange)):
                self.keep(rest, *self.by_library([w[1:] for w in rest.to_pylist()]))
            known = self.known.find(words)
        self.known.used(known, np.bincount(codes, minlength=len(known)))
        lengths = self.sizes(known)[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.gather(known[codes], lengths), ends[offsets]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file."""
    kept = store_of("wordids")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]
