"""Toxicity scores from a learned lexicon, found through misspellings and weighed by context.

Terms that mark toxic documents are learned from labelled rows.  A trie of them is intersected with Levenshtein
automata of one edit and made deterministic, so that a table look-up per character finds exact, misspelled and
stemmed terms in all distinct words at once.  Whether a hit stands between quotation marks within a window of
words decides which counter it goes to; a logistic regression weighs the counters.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.base import held_out, ship, slices, table, word_codes

#: Bounds of the labelled sample that lexicon and weights are fitted on (smallest hashes of doc_id first).
TOXIC_ROWS, CLEAN_ROWS = 8_000, 12_000
#: Bounds of the lexicon (most toxic documents first).
WORDS, STEMS = 200, 60
#: A term occurs in so many toxic documents of the sample and share of them, and is so much likelier there.
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 3, 0.01, 20.0
STEM_LENGTHS = (4, 5, 6, 7)
#: Shorter terms must be spelled exactly.
FUZZY_LENGTH = 5
#: Words on either side that are searched for quotation marks and further hits.
WINDOW = 8
THRESHOLD = 0.3
QUOTES = "\"“”„‟«»"
EXACT, STEM, NEAR = 1, 2, 3
#: Counters: exact, stem and near hits outside quotation marks, quoted hits, hits with another hit in the window.
PRIOR = np.array([4.5, 4.0, 4.5, 0.0, 0.5, -4.0])
PRIOR_WEIGHT = np.array([0.5, 0.5, 0.5, 2.0, 0.5, 0.05])


class Automaton:
    """Deterministic automaton of words (one edit allowed from FUZZY_LENGTH letters on) and stems (any ending)."""

    def __init__(self, words: list[str], stems: list[str]) -> None:
        letters = sorted(set("".join(words + stems)))
        #: Code points of the lexicon's letters, whatever script; the last one is no character.
        self.letters = np.array([*map(ord, letters), 0x110000], dtype=np.int64)
        child: list[dict[int, int]] = [{}]
        word_end: dict[int, bool] = {}
        stem_end: set[int] = set()
        code = {ch: c for c, ch in enumerate(letters, 1)}
        for term, is_stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            node = 0
            for ch in term:
                if code[ch] not in child[node]:
                    child.append({})
                    child[node][code[ch]] = len(child) - 1
                node = child[node][code[ch]]
            if is_stem:
                stem_end.add(node)
            else:
                word_end[node] = len(term) >= FUZZY_LENGTH

        def closed(states: set) -> frozenset:
            if any(s[0] == "in" and s[2] == 0 and s[1] in stem_end for s in states) or ("stem",) in states:
                return frozenset([("stem",)])
            out = set(states)
            for s in states:  # a letter left out
                if s[0] == "in" and s[2] == 0:
                    out.update(("in", n, 1) for n in child[s[1]].values())
            return frozenset(out)

        def step(states: frozenset, c: int) -> frozenset:
            out: set = set()
            for s in states:
                if s[0] == "stem":
                    out.add(s)
                elif s[0] == "swap":
                    if s[2] == c:
                        out.add(("in", s[1], 1))
                else:
                    _, node, edits = s
                    if c in child[node]:
                        out.add(("in", child[node][c], edits))
                    if edits == 0:
                        out.add(("in", node, 1))  # a letter too many
                        for x, n in child[node].items():
                            out.add(("in", n, 1))  # another letter
                            if c in child[n]:
                                out.add(("swap", child[n][c], x))
            return closed(out)

        def told_apart(states: frozenset) -> set[int]:
            """Letters that lead elsewhere than a letter of no term does."""
            out: set[int] = set()
            for s in states:
                if s[0] == "swap":
                    out.add(s[2])
                elif s[0] == "in":
                    out.update(child[s[1]])
                    if s[2] == 0:
                        for n in child[s[1]].values():
                            out.update(child[n])
            return out

        def numbered(states: frozenset) -> int:
            if states not in number:
                number[states] = len(number)
                todo.append(states)
            return number[states]

        begin = closed({("in", 0, 0)})
        number, todo, rows = {begin: 0, frozenset(): 1}, [begin, frozenset()], []
        for states in todo:
            row = np.full(len(letters) + 1, numbered(step(states, 0)), dtype=np.int32)
            for c in told_apart(states):
                row[c] = numbered(step(states, c))
            rows.append(row)
        self.table = np.array(rows)
        self.found = np.zeros(len(todo), dtype=np.int8)
        for states, n in number.items():
            ends = [s for s in states if s[0] == "in" and s[1] in word_end]
            if any(s[2] == 0 for s in ends):
                self.found[n] = EXACT
            elif ("stem",) in states:
                self.found[n] = STEM
            elif any(word_end[s[1]] for s in ends):
                self.found[n] = NEAR

    def match(self, chars: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """What each word chars[first[i]:last[i] + 1] is: 0, EXACT, STEM or NEAR (words without letters: 0)."""
        at = np.searchsorted(self.letters, chars)
        classes = np.where(self.letters[at] == chars, at + 1, 0)
        state = np.zeros(len(first), dtype=np.int64)
        alive, step = np.flatnonzero(first <= last), 0
        state[first > last] = 1
        while len(alive):
            state[alive] = self.table[state[alive], classes[first[alive] + step]]
            step += 1
            alive = alive[(first[alive] + step <= last[alive]) & (state[alive] != 1)]
        return self.found[state]


#: Letters and digits below U+3000.
_CORE = np.array([chr(c).isalnum() for c in range(0x3000)])


def is_core(chars: np.ndarray) -> np.ndarray:
    """Letters and digits; from U+3000 on (Han, Hangul, kana, pictographs) all but punctuation and spaces."""
    out = _CORE[np.minimum(chars, len(_CORE) - 1)]
    far = np.flatnonzero(chars >= len(_CORE))
    if len(far):
        points, place = np.unique(chars[far], return_inverse=True)
        out[far] = np.array([unicodedata.category(chr(c))[0] not in "PZ" for c in points.tolist()])[place]
    return out


def cores(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, first and last letter or digit of each word, quotation mark before it, and after it)."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    word, n = np.repeat(np.arange(len(words)), length), len(words)
    core = np.flatnonzero(is_core(chars))
    first, last = np.full(n, len(chars) + 1), np.full(n, -1)
    first[word[core][::-1]] = core[::-1]
    last[word[core]] = core
    marks = np.flatnonzero(np.isin(chars, [ord(q) for q in QUOTES]))
    opening, closing = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    opening[word[marks[marks < first[word[marks]]]]] = True
    closing[word[marks[marks > last[word[marks]]]]] = True
    return chars, first, last, opening, closing


def counters(automaton: Automaton, texts: pa.Array) -> np.ndarray:
    """Per text the five counters of hits, from its whole text."""
    codes, offsets, words = word_codes(texts, lower="utf8")
    out = np.zeros((len(texts), 5))
    if not len(codes):
        return out
    chars, first, last, opening, closing = cores(words.to_pylist())
    kind = automaton.match(chars, first, last)[codes]
    hit = np.flatnonzero(kind)
    if not len(hit):
        return out
    doc = np.searchsorted(offsets, hit, side="right") - 1
    low, high = np.maximum(hit - WINDOW, offsets[doc]), np.minimum(hit + WINDOW + 1, offsets[doc + 1])
    opened, closed = (np.concatenate([[0], np.cumsum(x[codes])]) for x in (opening, closing))
    hits = np.concatenate([[0], np.cumsum(kind > 0)])
    quoted = (opened[hit + 1] > opened[low]) & (closed[high] > closed[hit])
    for at in (EXACT, STEM, NEAR):
        np.add.at(out[:, at - 1], doc[(kind[hit] == at) & ~quoted], 1)
    np.add.at(out[:, 3], doc[quoted], 1)
    np.add.at(out[:, 4], doc[(hits[high] - hits[low] > 1) & ~quoted], 1)
    return out


def design(counts: np.ndarray) -> np.ndarray:
    """Regression columns: counters on a scale where the first hit counts most, and a constant."""
    scaled = np.log2(1.0 + np.minimum(counts, 1e6))
    return np.column_stack([np.minimum(scaled, 1.0) + 0.25 * np.maximum(scaled - 1.0, 0.0), np.ones(len(counts))])


def weigh(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression that starts from PRIOR and leaves it as far as the rows ask for."""
    x, w = design(counts), PRIOR.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - p) - PRIOR_WEIGHT * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_WEIGHT), gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, automaton: Automaton, weights: np.ndarray, words: list[str], stems: list[str]) -> None:
        self.automaton, self.weights, self.words, self.stems = automaton, weights, words, stems

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(design(counters(self.automaton, texts)) @ self.weights, -30, 30)))


def labelled_sample(labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """At most toxic_rows + clean_rows rows (doc_id, toxic) of those that may be learned from.

    A doc_id with several labels counts as toxic if one says so.
    """
    one = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
           .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return (one.filter("toxic = 1").orderBy(*order).limit(toxic_rows)
            .unionAll(one.filter("toxic = 0").orderBy(*order).limit(clean_rows)))


def word_documents(rows: DataFrame) -> DataFrame:
    """(word, toxic_n, clean_n): documents of ``rows`` (text, toxic) that hold each lower-cased word core."""

    def count(batches):
        for batch in batches:
            for low, high in slices(batch.column(0)):
                codes, offsets, words = word_codes(batch.column(0).slice(low, high - low), lower="utf8")
                if not len(codes):
                    continue
                names = words.to_pylist()
                chars, first, last, _, _ = cores(names)
                start = np.cumsum([0, *map(len, names)])[:-1]
                core = pa.array([n[a:b] for n, a, b in zip(names, (first - start).tolist(), (last - start + 1).tolist())],
                                pa.string()).dictionary_encode()
                doc = np.repeat(np.arange(high - low), np.diff(offsets))
                pair = np.unique(core.indices.to_numpy()[codes] * (high - low) + doc)
                toxic = batch.column(1).slice(low, high - low).to_numpy()[pair % (high - low)]
                word = pair // (high - low)
                bad, good = (np.bincount(word, weights=w, minlength=len(core.dictionary)) for w in (toxic, 1 - toxic))
                yield pa.RecordBatch.from_arrays(
                    [core.dictionary, pa.array(bad.astype(np.int64)), pa.array(good.astype(np.int64))], names=["word", "toxic_n", "clean_n"])

    return (rows.select("text", "toxic").mapInArrow(count, "word string, toxic_n bigint, clean_n bigint")
            .groupBy("word").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n")).filter("word <> ''"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights from the labelled sample's whole texts.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic.  Driver memory is bounded by the sample and
    lexicon sizes above.  Without labelled rows the lexicon is empty and every text gets the prior's score.
    """
    spark = docs.sparkSession
    ship(spark)
    picked = labelled_sample(labels).collect()
    sample = spark.createDataFrame(picked, "doc_id long, toxic int")
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    n_toxic = sum(r.toxic for r in picked)
    n_clean = len(picked) - n_toxic
    if not picked:
        return Model(Automaton([], []), PRIOR, [], [])
    words = word_documents(rows)
    least = max(LEAST_DOCS, LEAST_SHARE * n_toxic)
    odds = ((F.col("toxic_n") + 0.5) / (n_toxic + 1)) / ((F.col("clean_n") + 0.5) / (n_clean + 1))
    fine = (F.col("toxic_n") >= least) & (odds >= LEAST_ODDS)
    lengths = F.array(*[F.lit(k) for k in STEM_LENGTHS])
    stems = (words.filter(F.length("word") > min(STEM_LENGTHS)).select(
        F.explode(F.transform(F.filter(lengths, lambda k: k < F.length("word")), lambda k: F.substring("word", F.lit(1), k))).alias("term"),
        "toxic_n", "clean_n").groupBy("term").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"), F.count("*").alias("forms"))
        .filter(fine & (F.col("forms") >= 3)).orderBy(F.desc("toxic_n"), F.length("term"), "term").limit(4 * STEMS).collect())
    kept_words = [r.word for r in words.filter(fine).orderBy(F.desc("toxic_n"), "word").limit(WORDS).collect()]
    kept_stems: list[str] = []
    for r in sorted(stems, key=lambda r: (len(r.term), r.term)):  # the shortest that is good enough stands for the longer ones
        if not any(r.term.startswith(s) for s in kept_stems):
            kept_stems.append(r.term)
    automaton = Automaton(kept_words, kept_stems[:STEMS])

    def count(batches):
        for batch in batches:
            for low, high in slices(batch.column(0)):
                got = counters(automaton, batch.column(0).slice(low, high - low))
                yield pa.RecordBatch.from_arrays([pa.array(got[:, i]) for i in range(5)] + [batch.column(1).slice(low, high - low)],
                                                 names=[*"abcde", "toxic"])

    got = rows.mapInArrow(count, "a double, b double, c double, d double, e double, toxic int").toPandas()
    weights = weigh(got[list("abcde")].to_numpy(), got["toxic"].to_numpy(dtype=float)) if len(got) else PRIOR
    return Model(automaton, weights, kept_words, kept_stems[:STEMS])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) of each row of ``docs`` (doc_id, text) from its whole text; NULL is an empty text.

    Repeated rows and NULL ids are scored like any other; an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(part.column(1)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op7_lexicon_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``; lexicon and weights come from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
