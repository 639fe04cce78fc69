"""Toxicity and language ID: automaton against brute force, held-out accuracy on the test tables."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadloom.llm import langid, toxicity
from roadloom.llm.langid import op8_marginal_unigrams
from roadloom.llm.toxicity import EXACT, NEAR, STEM, Automaton, cores, counters, op7_lexicon_automata, weigh

SF = "/root/testdata/sf0.01"


def one_edit(a, b):
    """At most one letter put in, left out, changed or swapped with its neighbour."""
    if a == b:
        return True
    if len(a) == len(b):
        d = [i for i in range(len(a)) if a[i] != b[i]]
        return len(d) == 1 or len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def test_automaton_equals_brute_force():
    words, stems = ["idiot", "loser", "scum", "moron", "ideal"], ["lowei", "vequ"]
    automaton = Automaton(words, stems)
    rng = random.Random(4)
    cases = ["idiot", "idoit", "idi0t", "scum", "scam", "loweitum", "lowe", "vequ", "vequx", "xvequ", "", "漢", "losers", "closer", "lloserr"]
    for _ in range(4000):
        w = list(rng.choice(words + stems))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "o", "i", "é"])
        cases.append("".join(w))
    chars, first, last, _, _ = cores(cases)
    got = automaton.match(chars, first, last)
    for w, g in zip(cases, got.tolist()):
        stem = any(w.startswith(s) for s in stems)
        want = STEM if stem else EXACT if w in words else NEAR if any(len(t) >= 5 and one_edit(w, t) for t in words) else 0
        assert g == want, (w, g, want)


def test_terms_of_any_script():
    automaton = Automaton(["바보", "멍청이들아", "白痴", "𠮷𠮷"], ["쓰레기같"])
    cases = ["바보", "바보。", "「白痴」", "白痴", "白", "멍청이들아", "멍청들아", "멍이청들아", "멍청이들다아", "쓰레기같은", "𠮷𠮷!", "바다", "漢字", "🙂"]
    chars, first, last, _, _ = cores(cases)
    assert automaton.match(chars, first, last).tolist() == [EXACT] * 4 + [0, EXACT, NEAR, NEAR, NEAR, STEM, EXACT, 0, 0, 0]
    words = "바보 白痴 idiot".split()
    texts = pa.array([f"그는 {w} 이다" for w in words] + ["그는 사람 이다"])
    assert counters(Automaton(words, []), texts)[:, 0].tolist() == [1, 1, 1, 0]


def test_terms_of_any_script_are_learned_and_found(spark):
    kept = [r.id for r in spark.range(400).filter(~toxicity.held_out("id")).orderBy("id").limit(120).collect()]
    term = {0: "바보。", 1: "白痴"}
    docs = [(i, f"오늘 {term.get(k % 4, '사람')} 天気 {k}") for k, i in enumerate(kept)] + [(1000, "너는 바보"), (1001, "他 白痴！ 了"), (1002, "오늘 사람")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k % 4 in term)) for k, i in enumerate(kept)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    assert {"바보", "白痴"} <= set(model.words)
    score = {r.doc_id: r.score for r in toxicity.scored(frame, model).collect()}
    assert score[1000] >= toxicity.THRESHOLD and score[1001] >= toxicity.THRESHOLD > score[1002]


def test_quotation_and_windows():
    automaton = Automaton(["idiot", "moron"], [])
    texts = ["You IDIOT!! you moron", 'she said "you are an idiot" then left', "an idoit (sic)", None, "", "nothing", 'idiot ' + "word " * 30 + '"quoted" word']
    got = counters(automaton, pa.array(texts))
    assert got.tolist() == [[2, 0, 0, 0, 2], [0, 0, 0, 1, 0], [0, 0, 1, 0, 0], [0] * 5, [0] * 5, [0] * 5, [1, 0, 0, 0, 0]]


def test_weights_follow_the_rows():
    counts = np.array([[1, 0, 0, 0, 0]] * 50 + [[0, 0, 1, 0, 0]] * 50 + [[0, 0, 0, 0, 0]] * 200, dtype=float)
    weights = weigh(counts, np.array([1] * 50 + [0] * 250, dtype=float))
    assert weights[0] > 3 and weights[2] < 2.5  # near misses that are always harmless lose their weight


def test_toxicity_on_held_out_rows(spark):
    got = (op7_lexicon_automata(spark, SF).filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id")
           .toPandas())
    toxic = got.toxic == 1
    assert (got.predicted[toxic] == 1).mean() >= 0.9
    assert (got.predicted[~toxic] == 0).mean() >= 0.97
    ranks = got.score.rank()
    assert (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.words == b.words and a.stems == b.stems and np.allclose(a.weights, b.weights)
    assert {"idiot", "moron", "loser"} <= set(a.words)


def test_language_on_held_out_rows(spark):
    got = op8_marginal_unigrams(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_model_ignores_missing_languages(spark):
    df = spark.createDataFrame([("der die das und", "de"), ("the and of this", "en"), ("le la les", None), (None, "fr")], "text string, lang string")
    model = langid.fit(df)
    assert model.languages == ["de", "en"]
    docs = spark.createDataFrame([(1, "und die"), (2, "this and"), (3, "12 %"), (4, None), (5, "")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()} == {1: "de", 2: "en", 3: "und", 4: "und", 5: "und"}
    assert sorted(r.doc_id for r in langid.keep_identified(docs, model).collect()) == [1, 2]


def test_texts_that_languages_share_are_kept(spark):
    langs = {"de": "alt", "en": "bird", "es": "casa", "fr": "deux", "it": "ecco"}
    df = spark.createDataFrame([(f"{w} radio", lang) for lang, w in langs.items()], "text string, lang string")
    model = langid.fit(df)
    docs = spark.createDataFrame([(1, "radio"), (2, "Radio."), (3, "deux"), (4, "12 %"), (5, None), (6, ""), (7, "zzz"), (8, "漢")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert got[1].score < 0.5 and got[1].lang_pred != "und"
    assert sorted(r.doc_id for r in langid.keep_identified(docs, model).collect()) == [i for i in got if got[i].lang_pred != "und"] == [1, 2, 3, 7, 8]
