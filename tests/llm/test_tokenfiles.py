import glob
import os
import zlib

import numpy as np
import pytest

from roadloom.llm import tokenfiles
from roadloom.llm.wordids import word_bpe_path

DOCS = [(i * 7 % 100, f"document number {i} " + "and some words " * (i % 9)) for i in range(100)]
DOCS += [(500, None), (501, ""), (None, "no id"), (7, "an id twice"), (502, "long text " * 40_000), (503, "漢字 it’s <|endoftext|>"), (-5, "negative")]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe_path())


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens") / "t")
    docs = spark.createDataFrame([(*r, 1, 2) for r in DOCS], "doc_id long, text string, place int, file int").repartition(4)
    tokenfiles.write_tokens(docs, folder, file_bytes=100_000)
    return folder


def open_file(name, dictionary):
    with open(name, "rb") as f:
        data = f.read()
    reads = []

    def read(start, size):
        reads.append(size)
        return data[start:start + size]

    return tokenfiles.TokenFile(read, len(data), dictionary), reads


def names(folder):
    return [n for n in sorted(glob.glob(f"{folder}/files/part-*")) if os.path.getsize(n)]


def test_round_trip_in_order(spark, written, library):
    rows = sorted(tokenfiles.with_starts(tokenfiles.read_tokens(spark, written)).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted((d for d, _ in DOCS), key=lambda d: (d is not None, d))
    want = sorted((d is not None, d or 0, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in DOCS)
    got = sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert got == want
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
    assert len({r.file for r in rows}) > 3


def test_one_document_is_read_alone(spark, written, library):
    dictionary = tokenfiles.read_dictionary(spark, written)
    assert dictionary
    found = 0
    for name in names(written):
        file, reads = open_file(name, dictionary)
        for doc_id, text in DOCS[:40]:
            for place in file.find(doc_id):
                del reads[:]
                got = file.document(place).tolist()
                wanted = [library.encode(t, add_special_tokens=False).ids + [2] for d, t in DOCS if d == doc_id]
                assert got in wanted and len(reads) == 1 and reads[0] < 400
                found += 1
    assert found >= 40


def test_damage_is_seen(written, spark):
    name = names(written)[0]
    with pytest.raises(ValueError, match="another dictionary"):
        open_file(name, b"something else")
    with open(name, "rb") as f:
        data = f.read()
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(lambda a, n: data[:-9][a:a + n], len(data) - 9, tokenfiles.read_dictionary(spark, written))


def test_the_dictionary_makes_short_documents_smaller():
    rng = np.random.default_rng(1)
    pieces = [rng.integers(0, 40_000, 12, dtype=np.uint16) for _ in range(60)]
    samples = [np.concatenate([pieces[i] for i in rng.choice(60, 6)]).tobytes() for _ in range(800)]
    import zstandard

    trained = zstandard.ZstdCompressor(level=3, dict_data=tokenfiles._dictionary(tokenfiles.train(samples[:600])))
    alone = zstandard.ZstdCompressor(level=3)
    assert sum(len(trained.compress(s)) for s in samples[600:]) < 0.6 * sum(len(alone.compress(s)) for s in samples[600:])
    assert tokenfiles.train([]) == b"" and tokenfiles.train([b"ab", b"cd"]) == b"abcd"


def test_empty_table(spark, tmp_path):
    tokenfiles.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "t"))
    assert tokenfiles.with_starts(tokenfiles.read_tokens(spark, str(tmp_path / "t"))).collect() == []
