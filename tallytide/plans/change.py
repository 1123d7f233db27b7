"""Change against a baseline time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.functions import log2fc
from tallytide.operators.aggregates import max_abs_change, mean_by_time
from tallytide.operators.joins import attach_baseline, restrict_to
from tallytide.operators.ranking import ordered, time_axis, top_changed
from tallytide.operators.reshape import pivot_values
from tallytide.operators.sizing import settle


def fold_change(
    normalized: DataFrame,
    baseline: int = 0,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "log2_cpm",
    also: Sequence[str] = ("time_point",),
    absent: str = "skip",
    sample: str = "sample_id",
    samples: DataFrame | None = None,
) -> DataFrame:
    """Mean level per entity and time after the baseline, minus the entity's baseline mean.

    With ``absent="zero"`` every entity has a baseline and all times; see ``mean_by_time``.
    """
    means = mean_by_time(
        normalized, entity, t, value, also, absent=absent, sample=sample, samples=samples
    )
    return attach_baseline(means, baseline, entity, t).withColumn(
        "log2fc", log2fc("mean_log2_cpm", "ctrl_expr")
    )


def changed_entities(
    changes: DataFrame, threshold: float = 1.0, entity: str = "gene_id"
) -> DataFrame:
    """Entities whose largest absolute change exceeds the threshold; equal is not enough."""
    return max_abs_change(changes, entity).filter(F.col("max_abs_log2fc") > threshold)


def fold_change_for(
    normalized: DataFrame,
    ids: DataFrame,
    baseline: int = 0,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "log2_cpm",
    also: Sequence[str] = ("time_point",),
) -> DataFrame:
    """``fold_change`` of the listed entities, in (entity, time) order.

    The restriction is applied to the normalised rows, ahead of every shuffle.
    """
    listed = restrict_to(normalized, ids, entity)
    return ordered(fold_change(listed, baseline, entity, t, value, also), [entity, t])


def heat_matrix(
    changes: DataFrame, n: int = 50, entity: str = "gene_id", t: str = "hours"
) -> DataFrame:
    """Entity by time table of the n most changed entities, times in order; gaps stay null."""
    table = settle(changes.select(entity, t, "log2fc")).table
    rows = restrict_to(table, top_changed(table, n, entity), entity)
    times = [row[0] for row in time_axis(table, t).collect()]
    return pivot_values(rows, [entity], t, times, "log2fc", F.avg)
