"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import held_out, training_part, unit_hash, written

FIT_ROWS = 40_000
LEXICON_TERMS = 400
LEAST_TOXIC = 5
CALIBRATION_SHARE = 0.2
LEXICON_SHARE = 0.4
THRESHOLD = 0.7
NEAR_WORDS = 5
CACHED = 300_000
STEMS = (6, 5, 4)
#: General insults, second-person pronouns, and look-alikes of letters.
INSULTS = (
    "idiot moron loser scum trash clown pathetic worthless disgusting stupid dumb fool imbecile "
    "jerk creep filth vermin garbage coward liar"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch "
    "usted ustedes tú ti tus vosotros vuestro"
).split()
LOOK_ALIKES = str.maketrans("013457@$!|", "oieastasil", "*._-#+~")
WORD = re.compile(r"\w+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._#+~-]+[^\W\d_]+)+")
FEATURES = (
    "log_words fixed_density learned_density weight_density greatest_weight hits near_share "
    "nearest pronoun_density capital_share capital_words punctuation_share exclamations "
    "disguised_rate disguised_hits"
).split()


class ToxicityModel(NamedTuple):
    """Learned lexicon (term to weight), trees and calibration; trees are None without two classes,
    and then every score is ``base``."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float


class Lexicon(dict):
    """Word to weight: over 0 for insults, -1 for second-person pronouns, else 0.

    Terms are whole words or stems, written with a trailing star.
    """

    def __init__(self, terms: dict[str, float]):
        super().__init__()
        self.terms = terms
        self.fixed = frozenset(INSULTS)
        self.persons = frozenset(SECOND_PERSON)

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED:
            self.clear()
        if word in self.persons:
            value = -1.0
        else:
            value = self.terms.get(word, 0.0)
            for n in STEMS:
                value = max(value, self.terms.get(word[:n] + "*", 0.0) if len(word) >= n else 0.0)
            if word in self.fixed:
                value = max(value, 1.0)
        self[word] = value
        return value


def _marks() -> np.ndarray:
    """For each ASCII code: 1 for a capital, 2 for punctuation."""
    table = np.zeros(129, dtype=np.uint8)
    table[65:91] = 1
    for low, high in ((33, 48), (58, 65), (91, 97), (123, 127)):
        table[low:high] = 2
    return table


def features(text: str | None, lexicon: Lexicon, marks: np.ndarray) -> list[float]:
    """The dense features of a whole text; an empty one is all zeros but for the distance."""
    text = text or ""
    words = WORD.findall(text.lower())
    n = len(words)
    weights = np.fromiter(map(lexicon.__getitem__, words), dtype=np.float64, count=n)
    hits = np.flatnonzero(weights > 0)
    persons = np.flatnonzero(weights < 0)
    near, nearest = 0.0, 1.0
    if len(hits) and len(persons):
        at = np.searchsorted(persons, hits)
        above = np.abs(persons[np.minimum(at, len(persons) - 1)] - hits)
        below = np.abs(persons[np.maximum(at - 1, 0)] - hits)
        gaps = np.minimum(above, below)
        near = float((gaps <= NEAR_WORDS).mean())
        nearest = min(float(gaps.min()), 50.0) / 50.0
    fixed = sum(words[i] in lexicon.fixed for i in hits.tolist())
    total = float(weights[hits].sum())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(marks[np.minimum(codes, 128)], minlength=3) if len(codes) else np.zeros(3)
    chars, words_n = max(len(codes), 1), max(n, 1)
    shouted = sum(1 for w in re.findall(r"\b[A-Z]{2,}\b", text))
    disguised = DISGUISED.findall(text)
    revealed = sum(lexicon[w.lower().translate(LOOK_ALIKES)] > 0 for w in disguised)
    return [
        math.log1p(n),
        fixed / words_n,
        len(hits) / words_n,
        total / words_n,
        float(weights[hits].max()) if len(hits) else 0.0,
        math.log1p(len(hits)),
        near,
        nearest,
        len(persons) / words_n,
        kinds[1] / chars,
        shouted / words_n,
        kinds[2] / chars,
        text.count("!") / words_n,
        len(disguised) / words_n,
        math.log1p(revealed),
    ]


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents of each class that hold a word or stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = set(WORD.findall((text or "").lower()))
                stems = {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}
                counts[toxic].update(words | stems)
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array([counts[1][t] for t in terms], pa.int64()),
                    pa.array([counts[0][t] for t in terms], pa.int64()),
                ],
                ["term", "toxic", "clean"],
            )

    counted = rows.select("text", "toxic").mapInArrow(run, "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(rows: DataFrame) -> dict[str, float]:
    """The ``LEXICON_TERMS`` terms whose log odds for toxic documents stand out most."""
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (bad - F.col("toxic") + 0.5)) - F.log(b / (good - F.col("clean") + 0.5))
    ranked = (
        _term_counts(rows)
        .filter(F.col("toxic") >= LEAST_TOXIC)
        .select("term", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
        .filter("z > 3")
        .orderBy(F.desc("z"), "term")
        .limit(LEXICON_TERMS)
    )
    return {r["term"]: r["odds"] for r in ranked.collect()}


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` and ``features`` of their ``text``."""
    rows = rows.select(*keep, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, marks = Lexicon(shared.value), _marks()
        for batch in batches:
            found = [features(t.as_py(), words, marks) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.list_(pa.float64()))],
                [*keep, "features"],
            )

    found = rows.mapInArrow(run, f"{kinds}, features array<double>")
    return found.withColumn("features", array_to_vector("features"))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
) -> ToxicityModel:
    """Learn from about ``FIT_ROWS`` labelled documents outside the held-out third.

    A hash of the id cuts them into three parts that share no document: ``CALIBRATION_SHARE`` of them
    calibrates the probabilities, ``LEXICON_SHARE`` gives the lexicon, which is bounded, and the trees
    are grown on the rest. So neither trees nor calibration see features flattered by a lexicon of
    their own rows. Labels of one id are merged to their largest; null labels are ignored.
    """
    known = (
        labels.filter(training_part(doc_id) & F.col(toxic).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    )
    n = known.count()
    draw = unit_hash(F.col("doc_id"), seed=1)
    chosen = written(known.filter(draw < FIT_ROWS / max(n, 1)), "labels")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    part = unit_hash(F.col("doc_id"), seed=2)
    for_trees = part >= CALIBRATION_SHARE + LEXICON_SHARE
    for_lexicon = (part >= CALIBRATION_SHARE) & ~for_trees
    lexicon = _lexicon(rows.filter(for_lexicon))
    sample = written(with_features(rows.filter(~for_lexicon), lexicon, ["doc_id", "toxic"]), "features")
    sizes = {
        (r["t"], r["toxic"]): r["count"]
        for r in sample.groupBy(for_trees.alias("t"), "toxic").count().collect()
    }
    total = sum(sizes.values())
    base = sum(c for (_, y), c in sizes.items() if y == 1) / total if total else 0.0
    if not all(sizes.get((True, y)) for y in (0, 1)):
        return ToxicityModel(lexicon, None, None, base)
    trees = GBTClassifier(
        labelCol="toxic", maxIter=20, maxDepth=4, stepSize=0.2, seed=42, maxMemoryInMB=64
    ).fit(sample.filter(for_trees))
    rest = _probability(trees, sample.filter(~for_trees))
    calibration = None
    if all(sizes.get((False, y)) for y in (0, 1)):
        calibration = IsotonicRegression(labelCol="toxic", featuresCol="probability").fit(
            rest.select(F.col("toxic").cast("double").alias("toxic"), "probability")
        )
    return ToxicityModel(lexicon, trees, calibration, base)


def _probability(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows)
    found = vector_to_array("probability").getItem(1)
    return scored.withColumn("probability", found).drop("rawPrediction", "prediction")


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on).

    Null and empty texts are scored like any other, from features that are zero. Texts of any length
    are read whole. Repeated rows and null ids get a row each; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(model.base))
    else:
        scored = _probability(model.trees, with_features(rows, model.lexicon, ["doc_id"]))
        if model.calibration is not None:
            scored = model.calibration.transform(scored).withColumnRenamed("prediction", "score")
        else:
            scored = scored.withColumnRenamed("probability", "score")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        _bounded(F.col("score")).alias("score"),
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _bounded(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def detect_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and score all of them."""
    return score_toxicity(docs, fit_toxicity(docs, labels))
