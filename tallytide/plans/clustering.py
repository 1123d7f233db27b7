"""Entities grouped by their course over time."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallytide.operators.aggregates import mean_by_time, profiles_of_means
from tallytide.operators.joins import restrict_to
from tallytide.operators.ml import fit_clusters, silhouette
from tallytide.operators.ranking import top_variable
from tallytide.operators.reshape import feature_index, long_to_vector
from tallytide.operators.sets import distinct_values
from tallytide.operators.sizing import settle


class ClusterResult(NamedTuple):
    """Labels and profiles of the clusters, their centres, the labelled vectors, and of the fit its
    cost by round and whether the last round moved no centre."""

    labels: DataFrame
    profiles: DataFrame
    centres: DataFrame
    vectors: DataFrame
    cost: Sequence[float] = ()
    settled: bool = True

    @property
    def silhouette(self) -> DataFrame:
        """The score, computed when asked for."""
        return silhouette(self.vectors, "features", "cluster")


def _mean_vectors(
    means: DataFrame, times: DataFrame, entity: str, t: str, center: bool
) -> DataFrame:
    index = settle(feature_index(times.select(t), t, [F.col(t)]))
    if center:
        own = F.avg("mean_expr").over(Window.partitionBy(entity))
        means = means.withColumn("mean_expr", F.col("mean_expr") - own)
    return long_to_vector(means, [entity], t, "mean_expr", index, index.rows)


def time_profiles(
    normalized: DataFrame,
    times: DataFrame,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "log2_cpm",
    center: bool = False,
) -> DataFrame:
    """One vector per entity with its mean level at each listed time, gaps 0.

    ``center`` subtracts each entity's own mean over its times, so that shape and not level
    decides the distance between two entities.
    """
    means = mean_by_time(normalized, entity, t, value, out="mean_expr")
    return _mean_vectors(means, times, entity, t, center)


def cluster_time_profiles(
    normalized: DataFrame,
    n_features: int = 500,
    k: int = 5,
    seed: int = 42,
    entity: str = "gene_id",
    sample: str = "sample_id",
    t: str = "hours",
    value: str = "log2_cpm",
    ids: DataFrame | None = None,
    center: bool = False,
) -> ClusterResult:
    """K-means over the time profiles of the most variable entities, or of those in ``ids``.

    The entities' means are settled once, for the vectors and for the cluster profiles.
    """
    chosen = top_variable(normalized, n_features, entity, sample, value) if ids is None else ids
    listed = restrict_to(normalized, chosen, entity)
    means = settle(mean_by_time(listed, entity, t, value, out="mean_expr")).table
    vectors = _mean_vectors(means, distinct_values(normalized, [t]), entity, t, center)
    found = fit_clusters(vectors, entity, "features", k, seed)
    labels = found.rows.select(entity, "cluster")
    profiles = profiles_of_means(means, labels, entity, t)
    return ClusterResult(labels, profiles, found.centres, found.rows, found.cost, found.settled)
