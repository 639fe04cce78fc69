"""Substring dedup (gear chunks) and repeated windows (radix passes)."""

import hashlib
import random

import numpy as np
import pytest

from roadloom.llm import exchange, suffixes
from roadloom.llm.chunkdedup import cut_places, drop_repeats, without_repeats
from roadloom.llm.suffixes import without_repeated_windows


def brute(docs, depth):
    seen, out = {}, {}
    for i, t in docs:
        for s in range(len(b := (t or "").encode()) - depth + 1):
            w = b[s:s + depth]
            seen[w] = min(seen.get(w, i), i)
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - depth + 1):
            if seen[b[s:s + depth]] < i:
                gone[s:s + depth] = b"\1" * depth
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def result(df):
    return {r.row: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.data or b"").hexdigest()) for r in df.collect()}


def mixed(rng, n):
    """Documents of small alphabets and shared passages, so that windows repeat in all kinds of ways."""
    passages = ["".join(rng.choice("ab ") for _ in range(rng.randint(30, 200))) for _ in range(6)]
    passages += ["".join(rng.choice("abcdefgh é漢") for _ in range(rng.randint(30, 120))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [rng.choice(passages)[rng.randint(0, 20):] if rng.random() < 0.5 else "".join(rng.choice("abcdefghij klm") for _ in range(rng.randint(0, 90)))
                 for _ in range(rng.randint(0, 6))]
        docs.append((i * 3 + 1, "".join(parts)))
    return docs + [(2, None), (3, ""), (5, "a" * 400), (8, "a" * 130), (9, "a" * 49), (11, "漢" * 300), (12, "漢" * 40)]


@pytest.mark.parametrize("small", [False, True])
def test_windows_equal_brute_force(spark, monkeypatch, small):
    if small:  # many batches, ranges and segments
        monkeypatch.setattr(exchange, "BATCH_BYTES", 700)
        monkeypatch.setattr(exchange, "RANGE_PRINTS", 150)
        monkeypatch.setattr(suffixes, "SEGMENT", 100)
    docs = mixed(random.Random(8), 80)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(without_repeated_windows(df)) == brute(docs, 50)


def test_windows_at_other_depths(spark):
    docs = mixed(random.Random(9), 40)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(without_repeated_windows(df, depth=20, digit=9)) == brute(docs, 20)
    assert result(without_repeated_windows(df, depth=24, digit=24)) == brute(docs, 24)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_passages_are_caught_and_clean_texts_left_alone(spark):
    rng = random.Random(5)
    passage = words(rng, 60)
    docs = [(i, words(rng, 150)) for i in range(40)]
    docs += [(100 + i, f"{words(rng, 20)} {passage} {words(rng, rng.randint(5, 50))}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.row: r for r in without_repeats(df).collect()}
    for i, t in docs:
        if i <= 100:
            assert got[i].n_removed == 0 and got[i].data == t.encode()
        else:
            assert got[i].n_removed >= 0.5 * len(passage) and passage not in got[i].data.decode()
            assert t.startswith(got[i].data.decode()[:40])


def test_passages_without_spaces_and_in_other_scripts(spark):
    rng = random.Random(6)
    passage = "".join(chr(rng.randint(0x4E00, 0x9F00)) for _ in range(150))
    own = ["".join(chr(rng.randint(0x4E00, 0x9F00)) for _ in range(80)) for _ in range(2)]
    df = spark.createDataFrame([(1, own[0] + passage), (2, own[1] + passage), (3, None), (None, passage)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in drop_repeats(df).collect()}
    assert got[1] == own[0] + passage and got[3] is None and got[None] == passage
    assert got[2].startswith(own[1]) and len(got[2]) < 80 + 75


def test_cuts_resist_shifts():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 20_000).astype(np.uint8)
    shifted = np.concatenate([rng.integers(97, 123, 7).astype(np.uint8), data])
    a, b = (cut_places(d, np.array([0, len(d)])) for d in (data, shifted))
    assert len(np.intersect1d(a + 7, b)) > 0.98 * len(a)
    assert np.diff(np.concatenate([[0], a])).max() <= 128


def test_cuts_of_uniform_bytes_are_bounded():
    data = np.full(10_000, 97, dtype=np.uint8)
    assert np.diff(np.concatenate([[0], cut_places(data, np.array([0, 4000, 4000, 10_000]))])).max() <= 128


def brute_chunks(docs, run_bytes=80):
    """Substring dedup by plain loops: chunks of every text, then runs of copies whose neighbours an earlier text has side by side."""
    chunks = {}
    for place, (i, t) in enumerate(docs):
        raw = (t or "").encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        ends = cut_places(data, np.array([0, len(raw)])).tolist() if raw else []
        chunks[place] = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    first_chunk, first_pair = {}, {}
    for place, (i, _) in enumerate(docs):
        if i is None:
            continue
        for c in chunks[place]:
            first_chunk[c] = min(first_chunk.get(c, i), i)
        for p in zip(chunks[place], chunks[place][1:]):
            first_pair[p] = min(first_pair.get(p, i), i)
    out = []
    for place, (i, t) in enumerate(docs):
        runs, run = [], []
        for n, c in enumerate(chunks[place]):
            copy = i is not None and first_chunk[c] < i
            if run and not (copy and first_pair[chunks[place][n - 1], c] < i):
                runs.append(run)
                run = []
            if copy:
                run = [*run, n]
        gone = {n for r in [*runs, run] if sum(len(chunks[place][n]) for n in r) >= run_bytes for n in r}
        kept = b"".join(c for n, c in enumerate(chunks[place]) if n not in gone)
        out.append((i, len((t or "").encode()) - len(kept), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_chunks_equal_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(exchange, "BATCH_BYTES", 700)
        monkeypatch.setattr(exchange, "RANGE_PRINTS", 50)
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(4)]
    docs = [(i * 2, " ".join([*rng.choices(words, k=20), rng.choice(passages), *rng.choices(words, k=rng.randint(0, 20)), rng.choice(passages)])) for i in range(40)]
    docs += [(3, None), (5, ""), (None, passages[0]), (4, docs[2][1]), (4, docs[3][1])]
    got = [(r.row, r.n_removed, hashlib.sha256(r.data or b"").hexdigest()) for r in without_repeats(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()]
    want = brute_chunks(docs)
    assert sorted(got, key=str) == want and sum(n for _, n, _ in want) > 5000


def test_common_chunks_do_not_make_a_passage(spark):
    """Text put together from chunks of several earlier texts repeats nowhere and stays."""
    rng = random.Random(6)
    earlier = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 9) for _ in range(120)) for _ in range(12)]
    pieces = []
    for t in earlier:
        raw = t.encode()
        ends = cut_places(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])).tolist()
        pieces.append(raw[ends[2]:ends[3]].decode())
    docs = [*enumerate(earlier), (100, "".join(pieces))]
    got = {r.row: r.n_removed for r in without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[100] == 0


def test_identical_rows_are_dealt_apart(spark):
    docs = spark.createDataFrame([(7, "same text " * 100)] * 60, "doc_id long, text string").repartition(3)
    batches = exchange.BATCH_BYTES
    try:
        exchange.BATCH_BYTES = 10_000
        sizes = [r["count"] for r in exchange.Corpus(docs, docs["doc_id"], 1 / 30).frame.groupBy("batch").count().collect()]
    finally:
        exchange.BATCH_BYTES = batches
    assert sum(sizes) == 60 and max(sizes) < 25
