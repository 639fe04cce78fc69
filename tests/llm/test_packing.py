import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadloom.llm import known, wordids
from roadloom.llm.packing import pack
from roadloom.llm.wordids import WordEncoder, word_bpe_path


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe_path())


def encoded(encoder, texts):
    ids, off = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


TEXTS = ["", " ", "Hello, World's end!! it's 42nd", "straße ÉCOLE naïve ñandú", "a\x1cb \x85 c　d", "漢字 İstanbul ΑΣ ȺB", "é <|endoftext|> </w> x</w>",
         "tab\tnew\nline\r\n" * 3, "!!'s ''s d'll", "ª º ʰ ǆ", "😀😀 ok", "hello <|endoftext|> and <|startoftext|>x<|endoftext|>", "a\xa0b\xa0 \xa0", "it’s “quoted” don’t",
         "'sample can't 'Twas O'RE", "x1y22 1/2 a_b--c", "\x00\x01 \x7f \x1b"]


def test_encoder_equals_library(library):
    assert encoded(WordEncoder(word_bpe_path()), TEXTS) == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcXYZ '.,\n\té")), max_size=30), min_size=1, max_size=8))
def test_encoder_equals_library_on_any_text(library, texts):
    encoder = test_encoder_equals_library_on_any_text.__dict__.setdefault("encoder", WordEncoder(word_bpe_path()))
    assert encoded(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_store_keeps_to_its_limits(library, monkeypatch):
    monkeypatch.setattr(wordids, "KEPT_WORDS", 40)
    monkeypatch.setattr(wordids, "KEPT_BYTES", 600)
    encoder = WordEncoder(word_bpe_path())
    for i in range(12):
        texts = [*TEXTS, *(f"word{i}{j} again, common stuff" for j in range(20)), "y" * 900 + str(i)]
        assert encoded(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder.shrink()
    assert len(encoder.known) <= 40


def test_words_of_one_hash_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(known.Known, "hashes", lambda self, words: np.full(len(words), np.uint64(7)))
    encoder = WordEncoder(word_bpe_path())
    for texts in (["one two three", "four, five."], ["two six; one", "seven's"]):
        assert encoded(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_cover_every_id_once(spark, library):
    texts = ["word " * (i * 37 % 500) for i in range(120)] + ["long text " * 3000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = pack(df, sequence_tokens=128).collect()
    for i, t in enumerate(texts):
        pieces = sorted((r.start, r.ids, r.length, r.doc_tokens) for r in got if r.doc_id == i)
        ids = [x for _, raw, _, _ in pieces for x in np.frombuffer(raw, "<u4").tolist()]
        assert ids == library.encode(t or "", add_special_tokens=False).ids + [1]
        assert [s for s, *_ in pieces] == np.cumsum([0, *(n for _, _, n, _ in pieces)])[:-1].tolist()
        assert all(len(ids) == n for *_, n in pieces)
    places = sorted((r.sequence_id * 128 + r.offset, r.length) for r in got)
    assert [p for p, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
    assert all(r.offset + r.length <= 128 and r.length > 0 for r in got)
