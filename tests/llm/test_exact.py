from pyspark.sql import functions as F

from roadloom.llm.exact import chunks, drop_exact, exact_groups

SEA = "the sea is wide and the boat is small so row on "


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_chunks_put_together_are_the_text(spark):
    texts = ["", "a", SEA * 400, "x" * 20_000, "é漢😀 " * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chunks(F.col("t")).alias("c")).collect():
        assert "".join(r.c) == r.t
        assert all(0 < len(c) <= 2 * 4096 for c in r.c)


def test_insertion_moves_few_chunks(spark):
    import random
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(20_000))
    df = spark.createDataFrame([(text,), ("new words in front " + text,)], "t string")
    a, b = (set(r.c) for r in df.select(chunks(F.col("t")).alias("c")).collect())
    assert len(a & b) > 0.9 * len(a)


def test_groups_and_ties(spark):
    df = spark.createDataFrame([(5, "a  b"), (3, "a\tb"), (3, "a\tb"), (4, "a b "), (None, "a b"), (7, None), (6, ""), (8, "\n")],
                               "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(df).collect()}
    assert got == {(5, 3, 4, False), (3, 3, 4, True), (3, 3, 4, False), (None, 3, 4, False), (4, 4, 1, True), (7, 6, 2, False), (6, 6, 2, True), (8, 8, 1, True)}


def test_weak_digest_gives_the_same_groups(spark):
    texts = [SEA * 100, SEA * 100 + "x", SEA * 99, "x" * 9000, "x" * 9000, "y" * 9000, "z", "z", "", SEA * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weak = exact_groups(df, digest=lambda c: F.pmod(F.xxhash64(c), F.lit(2)))
    assert rows(weak) == rows(exact_groups(df))


def test_drop_exact_keeps_one_row_of_each(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, "a  b", "y"), (3, "c", "z"), (None, "d", "n")], "doc_id long, text string, kept string")
    got = drop_exact(df)
    assert got.columns == df.columns
    assert rows(got) == sorted([(1, "a b", "x"), (3, "c", "z"), (None, "d", "n")], key=str)
