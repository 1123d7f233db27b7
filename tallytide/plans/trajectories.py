"""Annotation groups over time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallytide.operators.aggregates import annotation_dynamics
from tallytide.operators.joins import annotate
from tallytide.operators.ranking import ordered


def dynamics(
    normalized: DataFrame,
    annotation: DataFrame,
    process: str = "immune_process",
    group: str = "functional_class",
    t: str = "hours",
    entity: str = "gene_id",
    value: str = "log2_cpm",
    in_order: bool = True,
) -> DataFrame:
    """Mean level and entity count per process, class and time, in that sort order.

    Without ``in_order`` the rows come unsorted, for use below another aggregate.
    """
    used = annotation.select(entity, process, group)
    table = annotation_dynamics(
        annotate(normalized, used, entity), process, group, t, entity, value
    )
    return ordered(table, [process, t, group]) if in_order else table
