import math
import random
import re

import numpy as np
import pytest

from roadloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k):
    """Every document scored for every item, by the contract's formulas."""
    lists = [(d, terms(t)) for d, t in docs]
    lists = [(d, t) for d, t in lists if t]
    n, total = len(lists), sum(len(t) for _, t in lists)
    df = {}
    for _, t in lists:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in lists:
            m = 100 - 25 + 25 * len(t) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * t.count(w) // (1000 * t.count(w) + 12 * m))
                        for w in terms(text) if w in df)
            if score > 0:
                scored.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    common, rare = ["the", "of", "Zug", "été"], [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(common, k=rng.randint(0, 12)) + rng.choices(rare, k=rng.randint(0, 8))) + rng.choice(["", ".", "-x", " 42"])) for i in range(n)]


@pytest.mark.parametrize(("segment_bytes", "short_share", "k"), [(1 << 20, 16, 5), (900, 4, 20), (300, 1, 3), (2000, 10**9, 7)])
def test_equals_brute_force(spark, segment_bytes, short_share, k):
    docs = corpus(3, 300) + [(1000 + i, "the of the w1 w2") for i in range(40)] + [(2000, None), (2001, ""), (2002, "?! \x7f")]
    items = [(1, "The w1 W2 w2 the"), (2, "w3 w4 w5 été Zug"), (3, "of"), (4, "unknown"), (5, "the the of zug w7"), (6, None), (7, "x 42 É été")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = lexical.build_index(frame, segment_bytes)
    got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), k, short_share=short_share).collect()
    assert sorted(tuple(r) for r in got) == brute_force(docs, items, k)


def test_items_in_blocks_equal_one_block(spark):
    docs = spark.createDataFrame(corpus(5, 120), "doc_id long, text string")
    items = spark.createDataFrame([(i, f"the w{i} w{i + 1} of été") for i in range(30)], "item_id long, text string")
    index = lexical.build_index(docs)
    assert sorted(map(tuple, lexical.search(index, items, block_bytes=100).collect())) == sorted(map(tuple, lexical.search(index, items).collect()))


def test_rank_skips_documents_of_long_lists():
    rng = np.random.default_rng(0)
    n = 20_000
    long_ = (np.arange(n), rng.integers(1, 50, n))
    short = (np.sort(rng.choice(n, 200, replace=False)), rng.integers(1000, 2000, 200))
    found = lexical.Ranking(20)
    looked = lexical.rank([long_, short], found, np.arange(n), np.ones(n, np.uint8))
    total = long_[1].copy()
    total[short[0]] += short[1]
    assert found.ids.tolist() == np.lexsort((np.arange(n), -total))[:20].tolist()
    assert looked < n // 4


def test_repeated_ids_and_names(spark):
    rows = [(None, "cat", 1, "b"), (2, "cat", 1, "b"), (2, "cat", 1, "b"), (1, "cat", 1, "b"), (3, "dog", 1, "b")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, docs int, terms string")
    items = spark.createDataFrame([("a", "cat", 1), ("a", "dog", 1), (None, "dog", 1)], "item_id string, text string, rank int")
    got = [(r.item_id, r.rank, r.doc_id) for r in lexical.search(lexical.build_index(docs), items).collect()]
    assert sorted(got, key=str) == sorted([("a", 1, None), ("a", 2, 1), ("a", 3, 2), ("a", 4, 2), (None, 1, 3)], key=str)
