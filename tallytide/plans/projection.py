"""Samples in the space of the most variable entities."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import PCAModel, StandardScalerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.operators.ml import fit_pca, fit_scaler, sample_coordinates
from tallytide.operators.ranking import top_variable
from tallytide.operators.reshape import feature_index, long_to_vector
from tallytide.operators.sizing import Settled, settle


class PcaResult(NamedTuple):
    """Coordinates and shares of the variance, and what ``score_samples`` places samples with: the
    axes, the scaler and the slots of the chosen entities."""

    coordinates: DataFrame
    ratios: DataFrame
    model: PCAModel
    scaler: StandardScalerModel
    slots: Settled


def entity_slots(ids: DataFrame, entity: str = "gene_id") -> Settled:
    """The listed entities numbered in id order."""
    return settle(feature_index(ids.select(entity), entity, [F.col(entity)]))


def sample_vectors(
    normalized: DataFrame,
    ids: DataFrame | Settled,
    keys: Sequence[str] = ("sample_id", "hours", "replicate"),
    entity: str = "gene_id",
    value: str = "log2_cpm",
) -> DataFrame:
    """One vector per sample over the listed entities or their slots, in id order, gaps 0."""
    index = ids if isinstance(ids, Settled) else entity_slots(ids, entity)
    return long_to_vector(normalized, keys, entity, value, index, index.rows)


def sample_pca(
    normalized: DataFrame,
    n_features: int = 500,
    k: int = 5,
    axes: int = 2,
    keys: Sequence[str] = ("sample_id", "hours", "replicate"),
    entity: str = "gene_id",
    value: str = "log2_cpm",
    ids: DataFrame | None = None,
) -> PcaResult:
    """Coordinates of the samples on the leading axes, and every axis's share of the variance.

    ``ids`` replaces the choice of the ``n_features`` most variable entities. Vectors are settled
    once for the passes that scale, fit and score them. The fit holds an n_features-squared matrix
    on the driver, which is why features are chosen first.
    """
    chosen = top_variable(normalized, n_features, entity, keys[0], value) if ids is None else ids
    slots = entity_slots(chosen, entity)
    vectors = settle(sample_vectors(normalized, slots, keys, entity, value)).table
    scaler = fit_scaler(vectors)
    scaled = scaler.transform(vectors).drop("features")
    model, ratios = fit_pca(scaled, "scaled_features", k)
    coordinates = sample_coordinates(model, scaled, axes, keys)
    return PcaResult(coordinates, ratios, model, scaler, slots)


def score_samples(
    result: PcaResult,
    normalized: DataFrame,
    axes: int = 2,
    keys: Sequence[str] = ("sample_id", "hours", "replicate"),
    entity: str = "gene_id",
    value: str = "log2_cpm",
) -> DataFrame:
    """Coordinates of any samples in the space of a fitted result, with the signs of its axes.

    Entities that were not chosen for the fit are ignored; chosen ones that a sample lacks are 0
    before scaling, as in the fit.
    """
    vectors = sample_vectors(normalized, result.slots, keys, entity, value)
    return sample_coordinates(result.model, result.scaler.transform(vectors), axes, keys)
