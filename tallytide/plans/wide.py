"""Principal components over every entity, by way of the matrix of samples."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.operators.reshape import feature_index, long_to_vector
from tallytide.operators.sizing import lookup_join, settle

#: Samples of which the driver holds a squared matrix (128 MB); more raise an error.
MAX_SAMPLES = 4096


class WidePca(NamedTuple):
    """``coordinates``: keys and PC1..PCn per sample; ``ratios``: (component, ratio);
    ``loadings``: entity, its mean and deviation, and its weight on every axis as L1..Ln."""

    coordinates: DataFrame
    ratios: DataFrame
    loadings: DataFrame


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def standardized_entities(
    normalized: DataFrame, entity: str, sample: str, value: str, samples: DataFrame
) -> DataFrame:
    """(entity, mean, deviation, scaled): z-scores of an entity over all ``samples``, absent cells and
    nulls as 0. Entities that do not vary get zeros."""
    slots = settle(feature_index(samples.select(sample), sample, [F.col(sample)]))
    cells = normalized.withColumn(value, F.col(value).cast("double"))
    dense = long_to_vector(cells, [entity], sample, value, slots, slots.rows, "__row")
    dense = dense.withColumn("__row", vector_to_array("__row"))
    mean = _total(F.col("__row")) / slots.rows
    centred = dense.withColumn("mean", mean).withColumn(
        "__row", F.transform("__row", lambda x: x - F.col("mean"))
    )
    squares = _total(F.transform("__row", lambda x: x * x))
    scaled = centred.withColumn("deviation", F.sqrt(F.try_divide(squares, F.lit(slots.rows - 1))))
    flat = ~(F.coalesce("deviation", F.lit(0.0)) > 0)
    z = F.transform("__row", lambda x: F.when(flat, F.lit(0.0)).otherwise(x / F.col("deviation")))
    return scaled.select(entity, "mean", "deviation", z.alias("scaled"))


def wide_pca(
    normalized: DataFrame,
    k: int = 5,
    axes: int = 2,
    keys: Sequence[str] = ("sample_id", "hours", "replicate"),
    entity: str = "gene_id",
    value: str = "log2_cpm",
    max_samples: int = MAX_SAMPLES,
) -> WidePca:
    """``sample_pca`` with all entities as features.

    Samples are few where entities are many: the inner products of the samples are summed over
    entities in a tree of partial matrices, and the driver holds only that samples-squared matrix.
    Its eigenvectors, scaled by the roots of its eigenvalues, are the coordinates. Loadings stay
    distributed, one row per entity; the largest one of an axis is positive. Axes beyond the rank
    have ratio and coordinates 0. The first key names a sample. Without rows all tables are empty;
    more than ``max_samples`` samples raise a ``ValueError``.
    """
    sample, spark = keys[0], normalized.sparkSession
    samples = settle(normalized.select(*keys).distinct())
    if samples.rows > max_samples:
        raise ValueError(f"{samples.rows} samples, but a matrix of {max_samples} at most fits the driver")
    names = [f"PC{i + 1}" for i in range(axes)]
    scaled = settle(standardized_entities(normalized, entity, sample, value, samples.table)).table
    products = np.zeros((0, 0))
    if samples.rows:
        rows = scaled.select(array_to_vector("scaled").alias("row"))
        rows = MLUtils.convertVectorColumnsFromML(rows, "row")
        products = RowMatrix(rows, numCols=samples.rows).computeGramianMatrix().toArray()
    found, vectors = np.linalg.eigh(products)
    order = np.argsort(-found)[: max(k, axes)]
    values = np.clip(found[order], 0.0, None)
    values[values <= 1e-12 * max(products.trace(), 1e-300)] = 0.0
    vectors, total = vectors[:, order], products.trace()
    ratios = [(i + 1, float(v / total) if total else 0.0) for i, v in enumerate(values[:k])]

    def weight(i: int) -> Column:
        if i >= len(values) or not values[i]:
            return F.lit(0.0)
        axis = F.array(*[F.lit(float(x)) for x in vectors[:, i] / np.sqrt(values[i])])
        return _total(F.zip_with("scaled", axis, lambda a, b: a * b))

    raw = scaled.select(entity, "mean", "deviation", *[weight(i).alias(f"L{i + 1}") for i in range(axes)])
    loads = [f"L{i + 1}" for i in range(axes)]
    peaks = raw.agg(*[F.min(F.struct(-F.abs(c), F.col(entity), F.col(c).alias("l")))["l"] for c in loads]).first()
    signs = [-1.0 if p is not None and p < 0 else 1.0 for p in peaks]
    loadings = raw.withColumns({c: F.col(c) * s for c, s in zip(loads, signs, strict=True)})
    places = [
        (s, *[float(vectors[s, i] * np.sqrt(values[i]) * signs[i]) if i < len(values) else 0.0 for i in range(axes)])
        for s in range(samples.rows)
    ]
    placed = spark.createDataFrame(places, ", ".join(["__idx int", *[f"{n} double" for n in names]]))
    numbered = feature_index(samples.table.select(sample), sample, [F.col(sample)])
    located = lookup_join(lookup_join(samples.table, numbered, sample), placed, "__idx")
    return WidePca(
        located.select(*keys, *names),
        spark.createDataFrame(ratios, "component int, ratio double"),
        loadings,
    )
