"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A word's probability is the sum
over all its segmentations into pieces (forward algorithm), a text's the product over its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.llm import lattice
from roadloom.llm.base import held_out, ship, slices, store_of, table, word_codes
from roadloom.llm.lattice import SPACE, piece_model_path

#: Added to the count of every piece.
SMOOTHING = 0.05
#: Word scores that a Python worker keeps; beyond it the store starts anew.
KEPT_WORDS = 150_000
UNKNOWN = "und"


class Model:
    """Languages and the log-probabilities of their pieces (pieces x languages)."""

    def __init__(self, path: str, languages: list[str], logp: np.ndarray, key: str) -> None:
        self.path, self.languages, self.logp, self.key = path, languages, logp, key


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """(lang, piece, n): how often each piece occurs in the texts of each language, over all rows of ``docs`` (text, lang)."""

    def count(batches):
        model = lattice.pieces(path)
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for low, high in slices(batch.column(0)):
                codes, offsets, words = word_codes(batch.column(0).slice(low, high - low), lower="none")
                encoded = model.model.encode(words.to_pylist(), num_threads=1) if len(words) else []
                sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
                ids = np.fromiter((i for e in encoded for i in e), dtype=np.int64, count=int(sizes.sum()))
                langs = batch.column(1).slice(low, high - low).dictionary_encode()
                of_word = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(offsets))
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    times = np.bincount(codes[of_word == k], minlength=len(words))
                    got = np.bincount(ids, weights=np.repeat(times, sizes), minlength=model.size)
                    counts[lang] = counts.get(lang, 0) + got
        for lang, got in counts.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(got[at].astype(np.int64))],
                names=["lang", "piece", "n"])

    return docs.mapInArrow(count, "lang string, piece int, n bigint").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str | None = None, smoothing: float = SMOOTHING) -> Model:
    """Piece probabilities per language from all rows of ``docs`` (text, lang) that have both.

    Driver memory: languages x vocabulary.
    """
    ship(docs.sparkSession)
    path = path or piece_model_path()
    rows = piece_counts(docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL"), path).toArrow()
    langs = sorted(set(rows["lang"].to_pylist()))
    table_ = np.zeros((lattice.pieces(path).size, len(langs)))
    if langs:
        at = np.searchsorted(np.array(langs, dtype=object), np.array(rows["lang"].to_pylist(), dtype=object))
        table_[rows["piece"].to_numpy(), at] = rows["n"].to_numpy()
    table_ += smoothing
    logp = np.log(table_) - np.log(table_.sum(axis=0, keepdims=True))
    return Model(path, langs, logp, f"{hash(logp.tobytes())}")


class WordScores:
    """Log-probabilities of words under every language, kept across batches."""

    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, lattice.pieces(model.path)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.values = np.zeros((1 << 12, len(self.model.languages)))

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.place) + len(words) > KEPT_WORDS:
            self.clear()
        missing = [w for w in words if w not in self.place]
        for part in lattice.in_parts(missing):
            built = lattice.build(self.pieces, [SPACE + w for w in part], self.model.logp)
            got, at = built.alpha[built.first + built.length], len(self.place)
            while at + len(part) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.values[at:at + len(part)] = got
            self.place.update(zip(part, range(at, at + len(part))))
        return self.values[np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))]


def verdicts(model: Model, texts: pa.Array, lettered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the best language, its posterior) per text; place len(languages) for none."""
    kept = store_of("langid")
    if model.key not in kept:
        kept.clear()
        kept[model.key] = WordScores(model)
    best, prob = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
    if model.languages and len(texts):
        codes, offsets, words = word_codes(texts, lower="none")
        rows = kept[model.key].rows(words.to_pylist())
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if len(filled):
            sums = np.add.reduceat(rows[codes], offsets[filled], axis=0)
            best[filled] = sums.argmax(axis=1)
            prob[filled] = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        best[~lettered], prob[~lettered] = len(model.languages), 0.0
    return best, prob


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__lettered")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row of ``docs`` (doc_id, text), from its whole text.

    lang_pred is the language of highest probability (ties: first in name order), score its posterior
    probability under equal priors.  A text that is NULL or has no letter is `und` with score 0, as is every text
    when no language was learned.  Repeated rows are scored each; words are runs without ASCII white space; an
    empty table gives no rows.
    """
    ship(docs.sparkSession)

    def score(batches):
        langs = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                best, prob = verdicts(model, part.column(1), part.column(2).to_numpy(zero_copy_only=False).astype(bool))
                yield pa.RecordBatch.from_arrays([part.column(0), langs.take(pa.array(best)), pa.array(prob)],
                                                 names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _lettered()).mapInArrow(score, f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that `predict` calls `und`: NULL texts and texts without a letter.

    A text that several languages share is kept, however low the posterior of the best one.  All columns are kept as they are.  Rows pass through the tasks that score them, so nothing
    is shuffled.  Without any learned language every row would go, so none does.
    """
    ship(docs.sparkSession)
    if not model.languages:
        return docs

    at, width = docs.columns.index("text"), len(docs.columns)

    def keep(batches):
        for batch in batches:
            for low, high in slices(batch.column(at)):
                part = batch.slice(low, high - low)
                best, _ = verdicts(model, part.column(at), part.column(width).to_numpy(zero_copy_only=False).astype(bool))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(best < len(model.languages))) for c in part.columns[:-1]], names=part.schema.names[:-1])

    plain = [f"c{i}" for i in range(width)]  # any column name is fine
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(plain, docs.schema)])
    return docs.select("*", _lettered()).toDF(*plain, "lettered").mapInArrow(keep, schema).toDF(*docs.columns)


def op8_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
