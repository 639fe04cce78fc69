import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from roadloom.llm import lattice, sampling
from roadloom.llm.base import mix64

PATH = lattice.piece_model_path()


@pytest.fixture(scope="module")
def store():
    return sampling.Blocks(PATH, 1.0)


def segmentations(store, text):
    """All (ids, log-probability) of a text, by recursion."""
    pieces, logp = store.pieces, store.logp[:, 0]
    places = {pieces.model.id_to_piece(i): i for i in range(pieces.size) if pieces.text[i] and i not in set(pieces.byte_ids)}

    def walk(rest):
        if not rest:
            yield (), 0.0
            return
        for n in range(1, min(pieces.longest, len(rest)) + 1):
            ids = (places[rest[:n]],) if rest[:n] in places else tuple(pieces.byte_ids[list(rest.encode()[:len(rest[0].encode())])]) if n == 1 else None
            if ids:
                for tail, p in walk(rest[n:]):
                    yield ids + tail, p + logp[list(ids)].sum()

    return dict(walk(lattice.SPACE + text.replace(" ", lattice.SPACE) if text else ""))


def draws(store, text, n, k):
    rows, off = sampling.blocks_of(store, pa.array([text] * n, pa.large_string()))
    keys = mix64(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(99))
    paths, has, rest = sampling.sample_texts(store, rows, off, keys, k)
    ids = [sampling.path_ids(store, p) for p in paths]
    for d in range(n):
        yield [(tuple(i[o[d]:o[d + 1]].tolist()), p.logp[d], p.top[d], rest[d]) for (i, o), p, h in zip(ids, paths, has) if h[d]]


@pytest.mark.parametrize("text", ["the", " the ", "a  b", "thé x", "漢the\n x", "no on"])
def test_samples_follow_the_law_without_replacement(store, text):
    every = segmentations(store, text)
    z = sum(map(math.exp, every.values()))
    p = {s: math.exp(v) / z for s, v in every.items()}
    n, first, second, total = 3000, collections.Counter(), collections.Counter(), 0.0
    for got in draws(store, text, n, 3):
        assert len({s for s, *_ in got}) == len(got) == min(3, len(p))
        assert all(abs(logp - math.log(p[s])) < 1e-6 for s, logp, *_ in got)
        assert [t for *_, t, _ in got] == sorted((t for *_, t, _ in got), reverse=True)
        first[got[0][0]] += 1
        second[got[1][0]] += 1
        # inclusion probabilities make the sum over samples an unbiased estimate of the whole
        total += sum(p[s] / -math.expm1(-math.exp(min(700.0, logp - rest))) for s, logp, _, rest in got) / n
    for s, q in p.items():
        again = sum(p[o] * q / (1 - p[o]) for o in p if o != s and p[o] < 1)
        assert abs(first[s] / n - q) < 0.04
        assert abs(second[s] / n - again) < 0.04
    assert abs(total - 1) < 0.05


def test_all_segmentations_when_there_are_few(store):
    for got in draws(store, "漢", 3, 5):
        assert {s for s, *_ in got} == set(segmentations(store, "漢"))
    for got in draws(store, "", 2, 3):
        assert [s for s, *_ in got] == [()]


TEXTS = ["", " ", "  two  spaces ", "tab\tnew\nline", "漢字😀 é", "a" * 3000, "word " * 800, "\x00odd\x7f", "plain text here", None]


def frame(spark, parts=3):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(parts)


def test_round_trip_and_seed(spark):
    rows = sampling.sampled(frame(spark), k=3).collect()
    assert all(r.round_trip for r in rows)
    model = lattice.pieces(PATH).model
    for r in rows:
        ids = np.frombuffer(r.ids, "<i4").tolist()
        assert len(ids) == r.n_ids and model.decode(ids) == (TEXTS[r.doc_id] or "")
    other = sampling.sampled(frame(spark, 1), k=3).collect()
    key = lambda r: (r.doc_id, r.sample, bytes(r.ids))
    assert sorted(map(key, rows)) == sorted(map(key, other))


def test_encode_and_decode(spark):
    coded = sampling.encoded(frame(spark))
    model = lattice.pieces(PATH).model
    assert {r.doc_id: np.frombuffer(r.ids, "<i4").tolist() for r in coded.collect()} == {i: model.encode(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in sampling.decoded(coded).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_forward_sums_equal_enumeration(store):
    words = [lattice.SPACE + w for w in ("the", "then", "é漢", "x", "nation")]
    got = lattice.build(store.pieces, words, store.logp)
    sums = got.alpha[got.first + got.length, 0]
    for w, s in zip(words, sums):
        assert abs(s - math.log(sum(map(math.exp, segmentations(store, w[1:]).values())))) < 1e-9


def test_places_in_order_of_packed_and_of_wide_keys():
    from roadloom.llm.lattice import in_order

    rng = np.random.default_rng(3)
    for high in (5, 1 << 20, 1 << 40):  # the last does not fit one number
        a, b = rng.integers(0, high, 2000), rng.integers(0, 50, 2000)
        assert (in_order(a, b) == np.lexsort((b, a))).all() and (in_order(b) == np.argsort(b, kind="stable")).all()
    assert len(in_order(np.zeros(0, np.int64))) == 0


def test_memory_goes_back_per_look_up_only(monkeypatch):
    import pyarrow as pa

    from roadloom.llm import base

    calls = []
    monkeypatch.setattr(base, "let_go", lambda: calls.append(1))
    column = pa.array(["abcd"] * 10)
    assert list(base.slices(column, 8, give_back=False)) == list(base.slices(column, 8)) and len(calls) == 5


def test_a_draw_stops_at_the_last_edge_of_a_node():
    from roadloom.llm.lattice import piece_model_path
    from roadloom.llm.sampling import Blocks
    import pyarrow as pa

    store = Blocks(piece_model_path(), 1.0)
    store.rows(pa.array(["▁segmentation", "▁a"], pa.large_string()))
    ends = store.edge_from.data[1:store.edge_from.n]
    last = np.unique(ends[ends > 0]) - 1
    assert np.isposinf(store.cum.data[last]).all() and np.isposinf(store.cum.data[:store.cum.n]).sum() == len(last)


def test_words_of_an_array_have_the_lattices_of_a_list(store):
    words = ["\u2581a", "\u2581segmentations", "\u2581\u00e9t\u00e9", "\u2581\U0001f600x", "\u2581"]
    table = pa.array(["\u2581zzz", *words, "\u2581b"], pa.large_string()).slice(1, len(words))
    a, b = lattice.build(store.pieces, words, store.logp), lattice.build(store.pieces, table, store.logp)
    for name in ("first", "length", "start", "end", "piece", "logp", "alpha"):
        assert np.array_equal(getattr(a, name), getattr(b, name))
    several = lattice.build(store.pieces, words, np.repeat(store.logp, 3, axis=1))
    assert several.alpha.shape == (len(a.alpha), 3) and np.allclose(several.alpha, a.alpha)


def test_spelled_characters_move_the_ids_behind_them(store):
    """Offsets of ids with characters that are several byte pieces, at the ends of texts too."""
    texts = ["\U00010348", "plain words", "", "\U00010348 in \U00010349 between\U00010348", "end"]
    rows, off = sampling.blocks_of(store, pa.array(texts, pa.large_string()))
    for path in sampling.sample_texts(store, rows, off, mix64(np.arange(len(texts), dtype=np.uint64)), 2)[0]:
        ids, at = sampling.path_ids(store, path)
        data, ends = sampling.decode_bytes(PATH, ids, at)
        got = [data[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])]
        assert ids.dtype == np.int32 and all(g in (t, "") for g, t in zip(got, texts)) and (at[1:] >= at[:-1]).all() and at[-1] == len(ids)
        assert got[1] in ("plain words", "") and any(got)
