import random

import numpy as np
import pyarrow as pa
import pytest

from roadloom.llm import minhash
from roadloom.llm.components import components
from roadloom.llm.minhash import CONTRACT, USUAL, Rule, near_groups, passes, shingle_sets, signatures


def shingles(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(docs, rule: Rule):
    sets = {i: shingles(t, rule.words) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and rule.share * common >= rule.of * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def noisy(rng, text, share):
    return " ".join(w if rng.random() > share else rng.choice("alpha beta gamma delta".split()) + str(rng.randrange(99)) for w in text.split())


def corpus(rng, n_texts, copies, length):
    docs, i = [], 0
    for _ in range(n_texts):
        base = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(2, length)))
        for _ in range(rng.randint(1, copies)):
            docs.append((i, noisy(rng, base, rng.choice([0, 0.01, 0.03, 0.05]))))
            i += 1
    return docs + [(i, ""), (i + 1, None), (i + 2, "One"), (i + 3, "one"), (i + 4, "two words"), (i + 5, "two words")]


@pytest.mark.parametrize("rule", [CONTRACT, USUAL])
def test_equals_brute_force(spark, rule):
    docs = corpus(random.Random(rule.words), 60, 6, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, near_groups(df, rule).collect())) == brute(docs, rule)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """Members far from the smallest id are reached through others, in buckets of several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 40)
    rng = random.Random(11)
    base = " ".join(f"w{i}" for i in range(150))
    docs = [(i, noisy(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03]))) for i in range(260)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, near_groups(df, CONTRACT).collect()))
    assert got == brute(docs, CONTRACT)
    assert len({c for _, _, c, _ in got}) > 3  # and not all of them


def test_sets_of_a_slice_are_those_of_the_texts():
    texts = pa.array(["one two three four", "five six seven eight nine", "a b c d"])
    whole, off = shingle_sets(texts, 3)
    part, _ = shingle_sets(texts.slice(1, 2), 3)
    assert part.tolist() == whole[off[1]:].tolist()


def test_sets_and_signatures():
    texts = pa.array(["A b\tC d", "a b c d", "a b", "ab", "", None, "é É x"])
    hashes, off = shingle_sets(texts, 3)
    sets = [hashes[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 0, 1]
    assert sets[0] == sets[1] and sets[2] != sets[3]
    sig = signatures(hashes, off, 8)
    assert (sig[0] == sig[1]).all() and (sig[4] == 0).all()


def test_signatures_estimate_similarity():
    a, b = (" ".join(f"w{i}" for i in range(lo, lo + 900)) for lo in (0, 100))
    hashes, off = shingle_sets(pa.array([a, b]), 1)
    sig = signatures(hashes, off, 2000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.04


def test_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(2)
    n = CONTRACT.hashes
    a = rng.integers(0, 2**32, (4000, n), dtype=np.uint32)
    for similarity, kept in ((0.85, 0.999), (0.3, 0.0)):
        b = np.where(rng.random((4000, n)) < similarity, a, a + np.uint32(1))
        share = len(passes(a, b, CONTRACT.least_matches())) / 4000
        assert share >= kept if kept else share < 0.001


def test_band_count_bounds_the_miss_probability():
    for rule in (CONTRACT, USUAL):
        assert (1 - rule.threshold**minhash.BAND_ROWS) ** rule.bands <= minhash.MISS


def test_looks_of_the_sequential_test_together_keep_the_miss_bound():
    for rule in (CONTRACT, USUAL):
        least, ends = rule.least_matches(), [*range(minhash.BATCH, rule.hashes, minhash.BATCH), rule.hashes]
        chance, dropped = {0: 1.0}, 0.0  # of so many matches, place by place, for a pair right at the threshold
        for n in range(1, rule.hashes + 1):
            chance = {m: chance.get(m, 0.0) * (1 - rule.threshold) + chance.get(m - 1, 0.0) * rule.threshold for m in range(n + 1)}
            if n in ends:
                dropped += sum(p for m, p in chance.items() if m < least[n])
                chance = {m: p for m, p in chance.items() if m >= least[n]}
        assert dropped <= minhash.MISS


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_whole_rows_are_not_shuffled_for_a_few_ids(spark, monkeypatch):
    """Few ids are sent to all tasks; with more of them than SENT rows meet theirs in a shuffle, with the same result."""
    docs = corpus(random.Random(5), 40, 4, 60)
    df = spark.createDataFrame([(i, "en", t) for i, t in docs], "doc_id long, lang string, text string")
    texts = df.select(df.doc_id.alias("id"), "text")
    few = minhash.drop_near(df, CONTRACT)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    [left] = minhash.among(spark.createDataFrame([(docs[0][0],), (docs[0][0],), (-5,)], "a long"), texts)
    assert [r.id for r in left.collect()] == [docs[0][0]]
    want = sorted(few.collect())
    assert {r.doc_id for r in want} == {i for i, _, _, kept in brute(docs, CONTRACT) if kept} and len(want) < len(docs)
    monkeypatch.setattr(minhash, "SENT", 0)
    many = minhash.drop_near(df, CONTRACT)
    assert minhash.among(spark.range(3), texts) == [texts] and sorted(many.collect()) == want
