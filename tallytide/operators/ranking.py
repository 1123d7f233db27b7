"""Order, limit and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallytide.functions import quoted
from tallytide.operators.aggregates import entity_variability, max_abs_change
from tallytide.operators.joins import annotate
from tallytide.operators.sizing import key_list


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n rows with the largest ``by``; nulls last, equal values in the order of ``tie``."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(n)


def top_n_per(
    df: DataFrame,
    group: str | Sequence[str],
    by: str,
    n: int,
    tie: str,
    out: str = "rank",
    parts: int = 64,
) -> DataFrame:
    """The n rows with the largest ``by`` of every group, numbered from 1 in ``out``; nulls last, equal
    values in the order of ``tie``. A null group is a group.

    A group is first cut into ``parts`` by a hash of ``tie``, and each part keeps its n best. Tasks drop
    what cannot be among them before the shuffle (up to the n of
    ``spark.sql.optimizer.windowGroupLimitThreshold``), and at most n rows a part meet in the last step,
    so a group with most of the rows is ranked by many tasks.
    """
    keys = [F.col(quoted(k)) for k in key_list(group)]
    order = [F.desc_nulls_last(quoted(by)), F.asc(quoted(tie))]
    part = F.pmod(F.xxhash64(F.col(quoted(tie))), F.lit(parts))
    within = Window.partitionBy(*keys, "__part").orderBy(*order)
    best = (
        df.withColumn("__part", part)
        .withColumn("__place", F.row_number().over(within))
        .filter(F.col("__place") <= n)
        .drop("__part", "__place")
    )
    overall = Window.partitionBy(*keys).orderBy(*order)
    return best.withColumn(out, F.row_number().over(overall)).filter(F.col(out) <= n)


def top_variable(
    normalized: DataFrame,
    n: int = 500,
    entity: str = "gene_id",
    sample: str = "sample_id",
    value: str = "log2_cpm",
    absent: str = "skip",
    samples: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` entities of largest variance; for ``absent`` see ``entity_variability``."""
    spread = entity_variability(normalized, entity, sample, value, absent, samples)
    return top_n(spread, "variance", n, entity)


def top_changed(changes: DataFrame, n: int = 50, entity: str = "gene_id") -> DataFrame:
    return top_n(max_abs_change(changes, entity), "max_abs_log2fc", n, entity)


def top_variable_per(
    normalized: DataFrame,
    annotation: DataFrame,
    group: str | Sequence[str] = "immune_process",
    n: int = 50,
    entity: str = "gene_id",
    sample: str = "sample_id",
    value: str = "log2_cpm",
    absent: str = "skip",
) -> DataFrame:
    """The ``n`` entities of largest variance of every annotation group, with their ``rank``.

    Variances are taken once per entity, so an entity of several groups is not summed up again for each.
    """
    spread = entity_variability(normalized, entity, sample, value, absent)
    listed = annotation.select(entity, *key_list(group)).distinct()
    return top_n_per(annotate(spread, listed, entity), group, "variance", n, entity)


def top_changed_per(
    changes: DataFrame, group: str | Sequence[str] = "hours", n: int = 50, entity: str = "gene_id",
    change: str = "log2fc",
) -> DataFrame:
    """The ``n`` entities of largest absolute change of every time, or of any other group of the rows."""
    found = changes.groupBy(*key_list(group), entity).agg(F.max(F.abs(change)).alias("max_abs_log2fc"))
    return top_n_per(found, group, "max_abs_log2fc", n, entity)


def ordered(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Sorted rows, or the first ``limit`` of them as a preview."""
    rows = df.orderBy(*keys)
    return rows if limit is None else rows.limit(limit)


def time_axis(df: DataFrame, t: str = "hours") -> DataFrame:
    """The distinct times in order."""
    return df.select(t).distinct().orderBy(t)
