"""The pipeline against a brute-force version on planted cases."""

import random

import corpus_pipeline


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_stages_and_run(spark, tmp_path):
    rng = random.Random(12)
    clean = {i: words(rng, 120) for i in range(30)}
    passage = words(rng, 70)
    docs = [(i, t, "en") for i, t in clean.items()]
    docs += [(40, "\t".join(clean[3].split()), "en"), (41, clean[5], "en")]  # exact copies
    near = clean[7].split()
    near[60] = "changed"
    docs += [(42, " ".join(near), "en")]
    docs += [(50 + i, f"{words(rng, 100)} {passage} {words(rng, 100)}", "en") for i in range(3)]
    docs += [(60, "### $$$ 123", "en"), (61, None, "en"), (62, "", "en")]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        assert now.columns == ["doc_id", "text", "lang"]
        kept.append({r.doc_id: r.text for r in now.collect()})
    every = {i for i, _, _ in docs}
    assert set(kept[0]) == every - {60, 61, 62}
    assert set(kept[1]) == set(kept[0]) - {40, 41}
    assert set(kept[2]) == set(kept[1]) - {42}
    assert set(kept[3]) == set(kept[2])
    assert all(kept[3][i] == t for i, t in clean.items())
    assert kept[3][50].count(passage) == 1 and all(passage not in kept[3][i] for i in (51, 52))
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, folder)
    ran = corpus_pipeline.run(spark, folder)
    assert {r.doc_id: r.doc_tokens for r in pieces.collect()} == {r.doc_id: r.doc_tokens for r in ran.collect()}
    assert {r.doc_id for r in ran.collect()} == set(kept[3])
