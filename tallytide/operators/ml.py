"""Scaling, principal components, k-means and silhouette on MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.functions import element
from tallytide.operators import kmeans
from tallytide.operators.sizing import lookup_join, settle


def standardize(
    df: DataFrame, by: str = "gene_id", value: str = "log2_cpm", out: str = "z"
) -> DataFrame:
    """Z-score of each value within its feature, long form; a constant feature gives 0, a null null.

    Mean and deviation come from an aggregate joined back, not from a window, so the rows of one
    feature never have to meet in one task.
    """
    stats = df.groupBy(by).agg(
        F.avg(value).alias("__mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("__sd"),
        F.count(F.lit(1)).alias("__rows"),
    )
    missing = F.col(value).isNull()
    z = F.when(~missing & (F.col("__sd") == 0), F.lit(0.0)).otherwise(
        (F.col(value) - F.col("__mean")) / F.col("__sd")
    )
    return lookup_join(df, stats, by, rows="__rows").withColumn(out, z).drop("__mean", "__sd")


def fit_scaler(
    df: DataFrame, vector: str = "features", out: str = "scaled_features"
) -> StandardScalerModel:
    """Means and sample deviations of every vector slot."""
    return StandardScaler(inputCol=vector, outputCol=out, withMean=True, withStd=True).fit(df)


def standardize_vectors(
    df: DataFrame, vector: str = "features", out: str = "scaled_features"
) -> DataFrame:
    """Every vector slot to mean 0 and sample deviation 1."""
    return fit_scaler(df, vector, out).transform(df)


def fit_pca(df: DataFrame, vector: str = "features", k: int = 5) -> tuple[PCAModel, DataFrame]:
    """Principal axes, and their shares of the variance as a (component, ratio) table."""
    model = PCA(k=k, inputCol=vector, outputCol="pca_features").fit(df)
    shares = [(i + 1, float(r)) for i, r in enumerate(model.explainedVariance.toArray())]
    return model, df.sparkSession.createDataFrame(shares, "component int, ratio double")


def axis_signs(model: PCAModel) -> list[float]:
    """A sign per axis that makes its largest loading positive; PCA itself leaves it open."""
    axes = model.pc.toArray()
    peaks = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return [1.0 if p >= 0 else -1.0 for p in peaks]


def sample_coordinates(
    model: PCAModel, df: DataFrame, n: int = 2, keys: Sequence[str] | None = None
) -> DataFrame:
    """Scores on the first ``n`` axes as columns PC1..PCn next to the keys."""
    vector = model.getInputCol()
    kept = [c for c in df.columns if c != vector] if keys is None else list(keys)
    signs = axis_signs(model)
    scores = model.transform(df).withColumn("__pcs", vector_to_array(model.getOutputCol()))
    return scores.select(
        *kept, *[(element("__pcs", i) * signs[i]).alias(f"PC{i + 1}") for i in range(n)]
    )


class Clusters(NamedTuple):
    """``rows``: key, vector and label of every entity; ``centres``: label and centre as an array;
    ``cost``: sum of squared distances to the nearest centre before each round and at the end;
    ``settled``: whether the last round moved no centre."""

    rows: DataFrame
    centres: DataFrame
    cost: Sequence[float] = ()
    settled: bool = True


def fit_clusters(
    df: DataFrame,
    key: str = "gene_id",
    vector: str = "features",
    k: int = 5,
    seed: int = 42,
    out: str = "cluster",
    rounds: int = kmeans.MAX_ROUNDS,
) -> Clusters:
    """K-means over entities, with labels numbered by the smallest key they hold.

    Labels depend on the data and the seed only; see ``kmeans.fit``. Rows are settled once for all
    rounds.
    """
    rows, _, n = settle(df.select(key, vector))
    points = rows.withColumn("__point", vector_to_array(vector))
    fit = kmeans.fit(points.select(key, "__point"), key, k, seed, n, rounds)
    spark = df.sparkSession
    if not fit.centres:
        none = spark.createDataFrame([], f"`{out}` int, centre array<double>")
        return Clusters(rows.withColumn(out, F.lit(0)), none)
    near = kmeans.nearest(F.col("__point"), fit.centres)["number"]
    found = points.withColumn("__found", near).drop("__point")
    first = found.groupBy("__found").agg(F.min(key).alias("least")).orderBy("least").collect()
    number = {r["__found"]: i for i, r in enumerate(first)}
    label = F.coalesce(*[F.when(F.col("__found") == f, F.lit(i)) for f, i in number.items()])
    centres = [(i, fit.centres[f]) for f, i in number.items()]
    return Clusters(
        found.withColumn(out, label).drop("__found"),
        spark.createDataFrame(centres, f"`{out}` int, centre array<double>"),
        fit.cost,
        fit.settled,
    )


def cluster_entities(
    df: DataFrame,
    key: str = "gene_id",
    vector: str = "features",
    k: int = 5,
    seed: int = 42,
    out: str = "cluster",
) -> DataFrame:
    """Key, vector and k-means label of every entity; see ``fit_clusters``."""
    return fit_clusters(df, key, vector, k, seed, out).rows


def misplaced(clusters: Clusters, vector: str = "features", label: str = "cluster") -> DataFrame:
    """One row: entities, labels in use, and entities nearer to another label's centre."""
    values = vector_to_array(vector)

    def gap(centre: list[float]) -> Column:
        squares = F.zip_with(
            values, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)
        )
        return F.round(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x), 9)

    gaps = {r[label]: gap(r["centre"]) for r in clusters.centres.collect()}
    own = F.coalesce(*[F.when(F.col(label) == k, g) for k, g in gaps.items()])
    least = F.array_min(F.array(*gaps.values()))
    return clusters.rows.select(label, own.alias("own"), least.alias("least")).agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count_distinct(label).alias("n_clusters"),
        F.count_if(F.col("own") > F.col("least")).alias("n_misplaced"),
    )


def silhouette(df: DataFrame, vector: str = "features", label: str = "cluster") -> DataFrame:
    """One row with the mean silhouette under squared Euclidean distance.

    Spark computes it from per-cluster sums, in one pass over the rows.
    """
    score = ClusteringEvaluator(featuresCol=vector, predictionCol=label).evaluate(df)
    return df.sparkSession.createDataFrame([(float(score),)], "silhouette double")
