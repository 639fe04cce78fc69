import numpy as np
import pytest

from roadloom.llm.sharding import hypergeometric, matrix_row, shard_sizes, uniform_shards


def test_sizes_and_slots(spark):
    got = uniform_shards(spark.range(0, 10_003, 1, 7), 24).collect()
    assert sorted(r.id for r in got) == list(range(10_003))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {len(v) for v in slots.values()} == {416, 417}


def test_same_seed_same_places(spark):
    a, b, c = (sorted(map(tuple, uniform_shards(spark.range(0, 500, 1, 3), 5, seed=s).collect())) for s in (1, 1, 2))
    assert a == b != c


def test_matrix_rows_fit_together():
    sizes = np.array([5, 0, 17, 1, 40, 9])
    before, places = np.concatenate([[0], np.cumsum(sizes)]), shard_sizes(int(sizes.sum()), 7)
    rows = np.array([matrix_row(before, places, p, 3) for p in range(6)])
    assert rows.sum(axis=1).tolist() == sizes.tolist()
    assert rows.sum(axis=0).tolist() == places.tolist()


def test_uniform(spark):
    """Each row reaches each shard and each slot equally often."""
    counts, slots = np.zeros((12, 3)), np.zeros((12, 4))
    for seed in range(60):
        for r in uniform_shards(spark.range(0, 12, 1, 3), 3, seed=seed).collect():
            counts[r.id, r.shard] += 1
            slots[r.id, r.slot] += 1
    assert ((counts - 20) ** 2 / 20).sum() < 60  # 22 degrees of freedom
    assert ((slots - 15) ** 2 / 15).sum() < 75  # 33 degrees of freedom


@pytest.mark.parametrize("scale", [1_000, 10**12])
def test_hypergeometric_mean_and_spread(scale):
    rng = np.random.default_rng(5)
    good, bad, drawn = 3 * scale, 7 * scale, 2 * scale
    got = np.array([hypergeometric(rng, good, bad, drawn) for _ in range(400)], dtype=float)
    sd = (drawn * 0.3 * 0.7 * (good + bad - drawn) / (good + bad - 1)) ** 0.5
    assert abs(got.mean() - drawn * 0.3) < 4 * sd / 20
    assert 0.85 < got.std() / sd < 1.15


def test_column_names_are_protected(spark):
    with pytest.raises(ValueError):
        uniform_shards(spark.range(3).withColumnRenamed("id", "shard"))
