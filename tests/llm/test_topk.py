import numpy as np

from roadloom.llm.topk import best_of_tile, products, top_k


def brute(vectors, every, k):
    out = []
    for q, a in vectors:
        if q % every == 0:
            got = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in vectors if v != q and len(a) == len(b))[:k]
            out += [(q, n, v, -s) for n, (s, v) in enumerate(got, 1)]
    return sorted(out)


def test_ties_blocks_and_tree(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.integers(-3, 4, 5 if i % 7 else 6).tolist()) for i in range(400)]
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>")
    got = top_k(df.filter("vec_id % 20 = 0"), df, k=4, block_queries=5, shard_rows=30, fan_in=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors, 20, 4)


def test_repeated_candidate_rows_and_few_candidates(spark):
    df = spark.createDataFrame([(0, [2]), (0, [2]), (1, [3]), (1, [3]), (2, [1])], "vec_id long, v array<long>")
    got = top_k(df.filter("vec_id = 0"), df, k=10)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 6), (0, 2, 1, 6), (0, 3, 2, 2)]


def test_products_are_exact_at_any_size():
    small, mid, big = np.array([[3, -2]]), np.array([[2**29 + 1, 2**29 + 3]]), np.array([[2**62, 2**62], [2**62, -(2**62)]])
    assert products(small, small).tolist() == [[13]]
    assert products(mid, mid).tolist() == [[(2**29 + 1) ** 2 + (2**29 + 3) ** 2]]
    assert products(big, big).tolist() == [[2**63 - 1, 0], [0, 2**63 - 1]]


def test_tile_selection_takes_smaller_ids_of_ties():
    assert best_of_tile(np.array([[5, 7, 7, 7, 5]]), np.array([9, 8, 1, 4, 2]), 2).tolist() == [[2, 3]]
