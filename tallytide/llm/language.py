"""Language by word frequencies, with character n-grams for words never seen."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallytide.llm.common import held_out, training_part, unit_hash

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 3000
WORDS_PER_LANGUAGE = 30_000
GRAMS_PER_SIZE = 20_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
#: Words after which more evidence of the same kind no longer raises the score.
SURE_AFTER = 30
CACHED = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


class LogTable(NamedTuple):
    """Rows of ``logs`` by item: one array for all, since every Python worker holds a copy."""

    rows: dict[str, int]
    logs: np.ndarray

    def get(self, item: str) -> np.ndarray | None:
        row = self.rows.get(item)
        return None if row is None else self.logs[row]


class LanguageModel(NamedTuple):
    """Centred log frequencies by language, of words and of n-grams."""

    languages: list[str]
    words: LogTable
    grams: LogTable


def _log_table(counts: list[tuple[str, str, int]], languages: list[str]) -> LogTable:
    place = {name: i for i, name in enumerate(languages)}
    rows: dict[str, int] = {}
    for _, item, _ in counts:
        rows.setdefault(item, len(rows))
    grid = np.full((len(rows), len(languages)), SMOOTHING)
    if not rows:
        return LogTable(rows, grid)
    for lang, item, n in counts:
        grid[rows[item], place[lang]] += n
    logs = np.log(grid / grid.sum(axis=0))
    logs -= logs.mean(axis=1, keepdims=True)
    return LogTable(rows, logs)


def _stacked(tables: list[LogTable]) -> LogTable:
    """Tables without a common item as one."""
    rows: dict[str, int] = {}
    for table in tables:
        rows |= dict(zip(table.rows, range(len(rows), len(rows) + len(table.rows)), strict=True))
    return LogTable(rows, np.concatenate([table.logs for table in tables]))


def _top(counts: DataFrame, item: str, keep: int) -> list[tuple[str, str, int]]:
    order = Window.partitionBy("lang").orderBy(F.desc("n"), item)
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    return [(r["lang"], r[item], r["n"]) for r in top.select("lang", item, "n").collect()]


def fit_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> LanguageModel:
    """Learn from about ``DOCS_PER_LANGUAGE`` labelled documents of each language.

    The sample is drawn by a hash of the id, outside the held-out third. Kept are the
    ``WORDS_PER_LANGUAGE`` most frequent words and, from the distinct words, the ``GRAMS_PER_SIZE``
    most frequent n-grams of each size and language, so the model's size is bounded. The number of
    language labels is taken to be small.
    """
    rows = docs.filter(training_part(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), unit_hash(F.col(doc_id)).alias("u")
    )
    shares = rows.groupBy("lang").agg((F.lit(DOCS_PER_LANGUAGE) / F.count("*")).alias("share"))
    languages = {r["lang"]: r["share"] for r in shares.collect()}
    if not languages:
        return LanguageModel([], _log_table([], []), _log_table([], []))
    share = F.coalesce(
        *[F.when(F.col("lang") == F.lit(k), F.lit(v)) for k, v in sorted(languages.items())]
    )
    sample = rows.filter(F.col("u") < share)
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    words = (
        sample.select("lang", F.explode(found).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    ).persist()
    names = sorted(languages)
    grams = []
    padded = F.concat(F.lit("_"), "word", F.lit("_"))
    for size in range(1, LONGEST_GRAM + 1):
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - size + 1, F.lit(1)))
        cut = F.transform(starts, lambda i, size=size: F.substring(padded, i, F.lit(size)))
        counted = (
            words.select("lang", F.explode(cut).alias("gram"))
            .filter(F.length("gram") == size)
            .groupBy("lang", "gram")
            .agg(F.count("*").alias("n"))
        )
        grams.append(_log_table(_top(counted, "gram", GRAMS_PER_SIZE), names))
    known = _log_table(_top(words.filter("n > 1"), "word", WORDS_PER_LANGUAGE), names)
    model = LanguageModel(names, known, _stacked(grams))
    words.unpersist()
    return model


class WordScores(dict):
    """Row numbers of words in ``grid``; a new word is scored once, unknown ones by n-grams."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.grid = np.zeros((4096, len(model.languages)))

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.grid):
            self.grid = np.concatenate((self.grid, np.zeros_like(self.grid)))
        known = self.model.words.get(word)
        self.grid[row] = self.backoff(word) if known is None else known
        self[word] = row
        return row

    def backoff(self, word: str) -> np.ndarray:
        """Mean over the places of a word of the longest known n-gram that starts there."""
        padded, grams = f"_{word}_", self.model.grams
        total = np.zeros(len(self.model.languages))
        for i in range(len(padded)):
            for size in range(min(LONGEST_GRAM, len(padded) - i), 0, -1):
                known = grams.get(padded[i : i + size])
                if known is not None:
                    total += known
                    break
        return total / len(padded)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall((text or "").lower())
        if not any(c.isalpha() for w in words for c in w) or not self.model.languages:
            return UNKNOWN, 0.0
        if len(self) > CACHED:
            self.clear()
        rows = [self[w] for w in words]
        mean = self.grid[rows].mean(axis=0) * min(len(rows), SURE_AFTER)
        best = int(mean.argmax())
        return self.model.languages[best], 1.0 / math.fsum(np.exp(mean - mean[best]))


def predict_language(
    docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    A known word counts with its log frequency in each language; an unseen one with its n-grams, at
    each place the longest known. The score is the softmax of the mean evidence of all words, scaled
    by their number up to ``SURE_AFTER``; equal languages go to the first by name.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text when there
    was nothing to learn from. Texts of any length are read whole. Repeated rows and null ids get a
    row each; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(LanguageModel(*shared.value))
        for batch in batches:
            found = [scores.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    predicted = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return predicted.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def identify_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and predict all of them."""
    return predict_language(docs, fit_language(docs, doc_id, text, lang), doc_id, text)


def keep_identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows whose language can be told, with all their columns; ``und`` goes.

    The test for ``und`` is a letter in the text, which needs no join of predictions to texts unless
    there is nothing to learn from: then every text is ``und``.
    """
    model = fit_language(docs, doc_id, text, lang)
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(LanguageModel(*shared.value))
        at = columns.index(text)
        for batch in batches:
            keep = [scores.predict(t.as_py())[0] != UNKNOWN for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
