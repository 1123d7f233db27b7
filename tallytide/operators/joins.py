"""Joins of counts to metadata, library sizes, baselines, annotations and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallytide.operators import sizing
from tallytide.operators.aggregates import keyed_totals
from tallytide.operators.sizing import Settled, broadcast_join, key_list, lookup_join, settle


def attach_metadata(
    long: DataFrame,
    metadata: DataFrame | Settled,
    sample: str = "sample_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add sample columns to long counts; samples unknown to the metadata drop out."""
    if columns is not None and isinstance(metadata, DataFrame):
        metadata = metadata.select(sample, *columns)
    return lookup_join(long, metadata, sample)


def filter_low_count(
    counts: DataFrame,
    min_total: int = 10,
    entity: str = "gene_id",
    count: str = "raw_count",
) -> DataFrame:
    """Keep the rows of entities whose total count reaches ``min_total``.

    An entity with only null counts has a null total and drops out. With too many entities to
    broadcast, the ones that fail may still be few enough: then those are broadcast and left out.
    """
    totals = settle(keyed_totals(counts, entity, count, "total_count"))
    passes = F.coalesce(F.col("total_count") >= min_total, F.lit(False))
    if totals.bytes > sizing.BROADCAST_LIMIT_BYTES:
        failing = settle(totals.table.filter(~passes).select(entity))
        if failing.bytes <= sizing.BROADCAST_LIMIT_BYTES:
            named = counts.filter(F.col(entity).isNotNull())
            return broadcast_join(named, failing.table, entity, "left_anti")
    passing = totals.table.filter(passes).drop("total_count")
    return lookup_join(
        counts, Settled(passing, totals.bytes, totals.rows), entity, "left_semi", rows="n_rows"
    )


def attach_library_size(
    counts: DataFrame,
    sample: str | Sequence[str] = "sample_id",
    count: str = "raw_count",
    out: str = "library_size",
) -> DataFrame:
    """Add each sample's total count to its rows."""
    sizes = keyed_totals(counts, sample, count, out)
    return lookup_join(counts, sizes, sample, rows="n_rows")


def attach_baseline(
    means: DataFrame,
    baseline: int = 0,
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "mean_log2_cpm",
    out: str = "ctrl_expr",
) -> DataFrame:
    """Rows after the baseline time, each with its entity's baseline value.

    ``means`` has one row per entity and time, so a window holds at most one row per time point
    however many samples an entity was measured in. Entities without a baseline row drop out; a
    baseline row with a null level stays a row. Where another column splits the baseline time of an
    entity into several rows, the largest level counts.
    """
    at_start = F.when(F.col(t) == baseline, F.struct(F.col(value).alias("level")))
    return (
        means.filter(F.col(t) >= baseline)
        .withColumn("__start", F.max(at_start).over(Window.partitionBy(entity)))
        .filter(F.col("__start").isNotNull() & (F.col(t) > baseline))
        .withColumn(out, F.col("__start.level"))
        .drop("__start")
    )


def annotate(df: DataFrame, annotation: DataFrame, entity: str = "gene_id") -> DataFrame:
    """Inner join to an annotation; an entity listed twice yields two rows."""
    return lookup_join(df, annotation, entity)


def attach_labels(
    df: DataFrame, labels: DataFrame, entity: str = "gene_id", label: str = "cluster"
) -> DataFrame:
    return lookup_join(df, labels.select(entity, label), entity)


def restrict_to(
    df: DataFrame, ids: DataFrame | Settled, key: str | Sequence[str] = "gene_id"
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``; repeated ids are dropped first."""
    listed = ids if isinstance(ids, Settled) else ids.select(*key_list(key)).distinct()
    return lookup_join(df, listed, key, "left_semi")


def present_samples(
    spark: SparkSession, columns: Sequence[str], sample: str = "sample_id"
) -> DataFrame:
    """A matrix header as a one-column table."""
    return spark.createDataFrame([(c,) for c in columns], f"`{sample}` string")


def missing_samples(
    metadata: DataFrame, present: DataFrame, sample: str = "sample_id"
) -> DataFrame:
    """Metadata ids that ``present`` lacks, once each."""
    ids = metadata.select(sample).distinct()
    return lookup_join(ids, present.select(sample).distinct(), sample, "left_anti")


def settled_ids(df: DataFrame, *columns: str) -> Settled:
    """The distinct ids of ``df`` computed once, for use by several later steps."""
    return settle(df.select(*columns).distinct())
