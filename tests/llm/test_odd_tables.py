"""Every query over tables with NULLs, empty and very long texts, ties, repeated rows, odd types and extra columns, and over empty ones."""

import math

import pytest

import corpus_pipeline
from roadloom.llm import exact, minhash, toxicity
from roadloom.llm.queries import QUERIES

LONG = "x" * 120_000 + " " + "wort " * 20_000

DOCS = [
    (1, "the cat sat on the mat and then the cat sat on the other mat again", "en"),
    (2, "the cat sat on the mat and then the cat sat on the other mat again", "en"),
    (2, "the cat sat on the mat and then the cat sat on the other mat again", "en"),
    (3, None, "en"), (4, "", None), (5, "   \t\n ", "de"), (6, "!!! ### $$$", "de"),
    (None, "the cat sat on the mat and then the cat sat on the other mat again", "en"),
    (None, None, None), (7, LONG, "de"), (8, LONG, "de"), (9, "漢字とかな交じり文の文書です。 ▁ ́e", None),
    (10, "a", "fr"), (11, "a b", "fr"), (12, "idiot you are a stupid clown", "en"), (13, "x  y   z  ", "en"),
]


def write_docs(spark, folder, rows):
    schema = ("doc_id long, text string, lang string, source string, n_chars long, shard int, slot long, kept boolean, "
              "batch int, row string, data string, sig binary, component string, __x int, `a.b` string")
    full = [(*r, "s", 1, 0, 1, True, 3, "r", "d", b"", "c", 5, "dot") for r in rows]
    spark.createDataFrame(full, schema).write.mode("overwrite").parquet(f"{folder}/documents.parquet")


def write_all(spark, folder, docs, vectors, labels, items):
    write_docs(spark, folder, docs)
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int, rank int, query_id string").write.mode(
        "overwrite").parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string, score double").write.mode(
        "overwrite").parquet(f"{folder}/labels.parquet")


    spark.createDataFrame(items, "item_id long, text string, doc_id long, rank string, score string, item int").write.mode("overwrite").parquet(
        f"{folder}/benchmark.parquet")


ITEMS = [(1, "The cat, the CAT!", 1, "r", "s", 0), (2, None, 1, "r", "s", 0), (3, "", 1, "r", "s", 0), (4, "nowhere", 1, "r", "s", 0),
         (None, "wort x", 1, "r", "s", 0), (5, "漢字とかな交じり文の文書です。", 1, "r", "s", 0), (5, "漢字とかな交じり文の文書です。", 1, "r", "s", 0)]
VECTORS = [(0, [1.0, 0.5], 1, 1, "q"), (100, [1.0, 0.5], 1, 1, "q"), (1, [1.0, 0.5], 1, 1, "q"), (2, None, 1, 1, "q"), (3, [1.0, None], 1, 1, "q"),
           (4, [math.nan, 1.0], 1, 1, "q"), (5, [math.inf, 1.0], 1, 1, "q"), (6, [], 1, 1, "q"), (7, [1.0, 2.0, 3.0], 1, 1, "q"),
           (None, [1.0, 1.0], 1, 1, "q"), (8, [-1.0, 3e38], 1, 1, "q"), (8, [-1.0, 3e38], 1, 1, "q")]
LABELS = [(12, 1, 1, "t", 0.5), (1, 1, 0, "t", 0.5), (None, 1, 1, "t", 0.5), (10, None, None, "t", 0.5), (12, 1, 0, "t", 0.5)]
ROWS = {"op3_bayes_minhash": len(DOCS), "op5_chunk_recipes": len(DOCS), "op7_lexicon_automata": len(DOCS), "op8_marginal_unigrams": len(DOCS),
        "op9_uniform_shards": len(DOCS), "op2_gear_chunks": len(DOCS), "op10_radix_windows": len(DOCS),
        "op12_filter_audit": 600, "op13_token_files": len(DOCS)}


@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("messy"))
    write_all(spark, folder, DOCS, VECTORS, LABELS, ITEMS)
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    write_all(spark, folder, [], [], [], [])
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_messy_rows(spark, messy, name):
    rows = QUERIES[name](spark, messy).collect()
    assert len(rows) == ROWS.get(name, len(rows))
    assert rows


def test_messy_rows_by_value(spark, messy):
    """Rows that the defined results of odd cases name."""
    ranked = sorted((r.item_id or 0, r.rank, r.doc_id or 0) for r in QUERIES["op11_hybrid_search"](spark, messy).collect())
    assert ranked == [(0, 1, 7), (0, 2, 8), (0, 3, 13), (1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 2), (5, 1, 9)]
    tokens = QUERIES["op13_token_files"](spark, messy).collect()
    assert sorted(r.start for r in tokens)[0] == 0 and sum(r.n_tokens for r in tokens if r.doc_id in (3, 4, 5)) == 3
    assert [r.doc_id for r in sorted(tokens, key=lambda r: r.start)] == sorted((d[0] for d in DOCS), key=lambda x: (x is not None, x))
    first = [r for r in QUERIES["op12_filter_audit"](spark, messy).collect() if r.filter_order == "EABCD"]
    assert [(r.step, r.removed, r.kept) for r in sorted(first, key=lambda r: r.step)][0] == (1, 4, 12)
    groups = {r.doc_id: r for r in QUERIES["op5_chunk_recipes"](spark, messy).collect() if r.doc_id in (1, 2, 4, 5)}
    assert groups[1].keep_id == 1 and groups[1].group_size == 4 and groups[4].group_size == 3 and not groups[5].kept
    near = {r.doc_id: r.component_id for r in QUERIES["op3_bayes_minhash"](spark, messy).collect()}
    assert (near[1], near[2], near[3], near[4], near[7], near[8], near[None]) == (1, 1, 3, 4, 7, 7, None)
    langs = {r.doc_id: r.lang_pred for r in QUERIES["op8_marginal_unigrams"](spark, messy).collect()}
    assert (langs[3], langs[4], langs[5], langs[6]) == ("und",) * 4 and langs[1] != "und"
    gone = sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in QUERIES["op10_radix_windows"](spark, messy).collect() if r.n_removed)
    assert [d for d, _ in gone] == [2, 2, 8] and {k for _, k in gone} == {0}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_pipeline_keeps_columns_and_survives_messy_rows(spark, messy, empty):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, messy)
        assert out.columns == docs.columns, name
        got = out.collect()
        docs = spark.createDataFrame(got, docs.schema)
    ids = sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    assert ids == [1, 7, 9, 10, 11, 12, 13]
    assert corpus_pipeline.run(spark, messy).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0


NAMES = ["__key", "__nth", "__id", "__sha", "__gone", "toxic", "kept_id", "sha", "nth", "c0", "c1"]


def test_any_column_names(spark):
    rows = [(1, "the cat sat on the mat and then the cat sat on the other mat again"),
            (2, "the cat  sat on the mat and then the cat sat on the other mat again"), (3, "something else altogether, you idiot")]
    docs = spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in NAMES))
    for out in (exact.drop_exact(docs), minhash.drop_near(docs)):
        got = sorted(tuple(r) for r in out.collect())
        assert out.columns == docs.columns and [r[0] for r in got] == [1, 3] and all(r[2:] == tuple(range(len(NAMES))) for r in got)
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.scored(docs, toxicity.fit(docs, labels)).count() == 3


def test_a_doc_id_with_two_texts_joins_their_components(spark):
    a, b = "one two three four five six seven eight nine ten", "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (3, b), (9, "quite another text of its own here")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_groups(docs, minhash.CONTRACT).collect())
    assert got == [(1, 1, True), (3, 1, False), (5, 1, False), (5, 1, False), (9, 9, True)]
