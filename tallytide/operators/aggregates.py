"""Grouped summaries. Each one combines map-side before its shuffle, so a key that holds a large
share of the rows sends one partial row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.functions import absolute
from tallytide.operators.sizing import key_list, lookup_join


def keyed_totals(df: DataFrame, key: str | Sequence[str], count: str, out: str) -> DataFrame:
    """Sum of ``count`` and number of rows per key; joins use the row number to find heavy keys."""
    return df.groupBy(*key_list(key)).agg(
        F.sum(count).alias(out), F.count(F.lit(1)).alias("n_rows")
    )


def entity_totals(
    counts: DataFrame, entity: str = "gene_id", count: str = "raw_count"
) -> DataFrame:
    return counts.groupBy(entity).agg(F.sum(count).alias("total_count"))


def library_sizes(
    counts: DataFrame, sample: str | Sequence[str] = "sample_id", count: str = "raw_count"
) -> DataFrame:
    return counts.groupBy(*key_list(sample)).agg(F.sum(count).alias("library_size"))


def _fills(absent: str) -> bool:
    """Whether absent cells count as zeros."""
    if absent not in ("skip", "zero"):
        raise ValueError(f"absent must be 'skip' or 'zero', not {absent!r}")
    return absent == "zero"


def entity_variability(
    normalized: DataFrame,
    entity: str = "gene_id",
    sample: str = "sample_id",
    value: str = "log2_cpm",
    absent: str = "skip",
    samples: DataFrame | None = None,
) -> DataFrame:
    """Sample variance, mean and row count per entity; one row gives a null variance.

    With ``absent="zero"`` every sample an entity has no row of counts as a zero, in closed form from
    the moments of the rows present and the number of samples, so no pair of entity and sample is made.
    ``samples`` lists the samples, by default those of ``normalized``, which has a row per entity and
    sample at most. A null value is unknown and no zero: its sample is left out for that entity.
    ``n_samples`` then is the number of samples that count.
    """
    if _fills(absent):
        total = (normalized if samples is None else samples).agg(F.count_distinct(sample)).first()[0]
        found = normalized.groupBy(entity).agg(
            F.coalesce(F.var_samp(value), F.lit(0.0)).alias("__var"),
            F.coalesce(F.avg(value), F.lit(0.0)).alias("__mean"),
            F.count(value).alias("__n"),
            (F.lit(total) - F.count_if(F.col(value).isNull())).alias("n_samples"),
        )
        n, size, mean = F.col("__n"), F.col("n_samples"), F.col("__mean")
        squares = F.greatest(n - 1, F.lit(0)) * F.col("__var")
        squares = squares + F.try_divide(mean * mean * n * (size - n), size)
        return found.select(
            entity,
            F.try_divide(squares, size - 1).alias("variance"),
            F.try_divide(mean * n, size).alias("mean_expr"),
            "n_samples",
        )
    return normalized.groupBy(entity).agg(
        F.var_samp(value).alias("variance"),
        F.avg(value).alias("mean_expr"),
        F.count(sample).alias("n_samples"),
    )


def mean_by_time(
    normalized: DataFrame,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "log2_cpm",
    also: Sequence[str] = (),
    out: str = "mean_log2_cpm",
    absent: str = "skip",
    sample: str = "sample_id",
    samples: DataFrame | None = None,
) -> DataFrame:
    """Mean level per entity and time; ``also`` adds columns that go with the time.

    With ``absent="zero"`` every entity has every time, and each sample of a time that the entity has
    no row of counts as a zero: sums are divided by the number of samples of the time. ``samples``
    lists the samples with their times, by default those of ``normalized``. A null value is unknown
    and no zero; a time with nothing but such values has a null mean. Only the time axis is collected.
    """
    if _fills(absent):
        key = [t, *also]
        listed = (normalized if samples is None else samples).groupBy(*key)
        axis = listed.agg(F.count_distinct(sample).alias("n")).orderBy(*key).collect()
        kinds = {f.name: f.dataType for f in normalized.select(*key).schema}
        place = lambda row: F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in key])
        places = [F.struct(place(r).alias("place"), F.lit(r["n"]).alias("n")) for r in axis]
        sums = F.struct(F.sum(value).alias("total"), F.count_if(F.col(value).isNull()).alias("unknown"))
        cells = normalized.groupBy(entity, *key).agg(sums.alias("__cell"))
        entries = F.collect_list(F.struct(F.struct(*key), "__cell"))
        rows = cells.groupBy(entity).agg(F.map_from_entries(entries).alias("__cells"))
        if not places:
            return rows.select(entity, *[F.lit(None).cast(kinds[c]).alias(c) for c in key], F.lit(0.0).alias(out))
        rows = rows.select(entity, "__cells", F.inline(F.array(*places)))
        cell = F.try_element_at("__cells", F.col("place"))
        known = F.col("n") - F.coalesce(cell["unknown"], F.lit(0))
        mean = F.try_divide(F.coalesce(cell["total"], F.lit(0.0)), known)
        return rows.select(entity, *[F.col("place")[c].alias(c) for c in key], mean.alias(out))
    return normalized.groupBy(entity, t, *also).agg(F.avg(value).alias(out))


def max_abs_change(
    changes: DataFrame, entity: str = "gene_id", change: str = "log2fc"
) -> DataFrame:
    return changes.groupBy(entity).agg(F.max(absolute(change)).alias("max_abs_log2fc"))


def annotation_dynamics(
    annotated: DataFrame,
    process: str = "immune_process",
    group: str = "functional_class",
    t: str = "hours",
    entity: str = "gene_id",
    value: str = "log2_cpm",
) -> DataFrame:
    """Mean level and number of entities per annotation process, class and time."""
    return annotated.groupBy(process, group, t).agg(
        F.avg(value).alias("mean_log2_cpm"), F.count_distinct(entity).alias("n_genes")
    )


def process_trajectory(
    dynamics: DataFrame,
    process: str = "immune_process",
    t: str = "hours",
    value: str = "mean_log2_cpm",
    weighted: bool = False,
    weight: str = "n_genes",
) -> DataFrame:
    """Mean over the classes of a process: each class counts once, or by ``weight``."""
    if weighted:
        mean = F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))
    else:
        mean = F.avg(value)
    return dynamics.groupBy(process, t).agg(mean.alias("mean_log2_cpm"))


def cluster_sizes(labels: DataFrame, label: str = "cluster", out: str = "n") -> DataFrame:
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias(out))


def profiles_of_means(
    means: DataFrame,
    labels: DataFrame,
    entity: str = "gene_id",
    t: str = "hours",
    label: str = "cluster",
) -> DataFrame:
    """Mean of the entity means per cluster and time, with the cluster's member count."""
    labelled = lookup_join(means, labels.select(entity, label), entity)
    profiles = labelled.groupBy(label, t).agg(F.avg("mean_expr").alias("mean_expr"))
    return lookup_join(profiles, cluster_sizes(labels, label, "n_entities"), label)


def cluster_profiles(
    normalized: DataFrame,
    labels: DataFrame,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "log2_cpm",
    label: str = "cluster",
) -> DataFrame:
    """``profiles_of_means`` from normalised rows."""
    means = mean_by_time(normalized, entity, t, value, out="mean_expr")
    return profiles_of_means(means, labels, entity, t, label)


def profile(
    df: DataFrame,
    entity: str = "gene_id",
    sample: str = "sample_id",
    approximate: bool = False,
) -> DataFrame:
    """One row with the number of rows, entities and samples."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct(F.col(entity)).alias("n_entities"),
        distinct(F.col(sample)).alias("n_samples"),
    )


def distinct_entities(
    df: DataFrame, entity: str = "gene_id", approximate: bool = False
) -> DataFrame:
    """One row with the number of distinct entities."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(distinct(F.col(entity)).alias("n_entities"))


def checksum(df: DataFrame, column: str) -> DataFrame:
    """One row with the global sum of a column."""
    return df.agg(F.sum(column).alias("checksum"))


def first_value(df: DataFrame, keys: Sequence[str], column: str, out: str = "value") -> DataFrame:
    """The value of each key. Keys are expected to be unique; of several values the largest is
    taken, where a plain ``first`` would depend on the order rows arrive in."""
    return df.groupBy(*keys).agg(F.max(column).alias(out))
