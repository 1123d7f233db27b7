"""Totals, library sizes and moments kept per batch of samples and merged, so that a new batch never
reads old rows again.

A state is a small Parquet table of one row per key, in a folder per batch. The moments of levels
merge as long as levels of old samples stay what they were: levels of ``normalize`` without a
low-count filter do, since a sample is scaled by its own library. With the filter a new batch may
bring back an entity dropped before, which changes old levels; take totals from the states first and
choose entities from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.operators.aggregates import entity_totals, library_sizes
from tallytide.functions import quoted


def moments(
    normalized: DataFrame, entity: str = "gene_id", sample: str = "sample_id", value: str = "log2_cpm"
) -> DataFrame:
    """(entity, n_samples, n, mean, m2): rows, values, their mean and sum of squared deviations."""
    return normalized.groupBy(entity).agg(
        F.count(sample).alias("n_samples"),
        F.count(value).alias("n"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"),
    )


def append_state(state: DataFrame, path: str, batch: str) -> None:
    """Write the state of a batch; a batch written again replaces itself, so a failed run is repeated."""
    if not batch or "/" in batch or batch[0] in "._":
        raise ValueError(f"not a name for a batch: {batch!r}")
    state.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all batches, with the column ``batch``."""
    kept = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return kept.withColumn("batch", F.col("batch").cast("string"))


def _merge(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    share = F.coalesce(F.try_divide(b["n"].cast("double"), n), F.lit(0.0))
    return F.struct(
        n.alias("n"),
        (a["mean"] + gap * share).alias("mean"),
        (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"),
    )


def merge_moments(states: DataFrame, entity: str = "gene_id") -> DataFrame:
    """Moments of all batches, merged in the order of their names. A key has a row per batch; write
    the result as one batch in place of the others when batches grow many."""
    part = F.struct("batch", F.struct(F.col("n"), F.col("mean"), F.col("m2")).alias("s"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    merged = F.aggregate(F.col("__parts"), start, lambda acc, p: _merge(acc, p["s"]))
    found = states.groupBy(entity).agg(
        F.sum("n_samples").alias("n_samples"), F.array_sort(F.collect_list(part)).alias("__parts")
    )
    found = found.withColumn("__all", merged)
    return found.select(entity, "n_samples", "__all.n", "__all.mean", "__all.m2")


def variability(merged: DataFrame, entity: str = "gene_id") -> DataFrame:
    """``entity_variability`` from merged moments."""
    return merged.select(
        entity,
        F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)).alias("variance"),
        F.when(F.col("n") > 0, F.col("mean")).alias("mean_expr"),
        "n_samples",
    )


def merge_totals(states: DataFrame, key: str, total: str) -> DataFrame:
    """Sums of a total per key over all batches; a null total of a batch adds nothing."""
    return states.groupBy(quoted(key)).agg(F.sum(total).alias(total))


def append_counts(counts: DataFrame, path: str, batch: str, count: str = "raw_count") -> None:
    """Totals per entity and library sizes of a batch, under ``path``."""
    append_state(entity_totals(counts, count=count), f"{path}/totals", batch)
    append_state(library_sizes(counts, count=count), f"{path}/libraries", batch)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """``entity_totals`` over all batches."""
    return merge_totals(read_states(spark, f"{path}/totals"), "gene_id", "total_count")


def read_libraries(spark: SparkSession, path: str) -> DataFrame:
    """``library_sizes`` over all batches; a sample may come in several."""
    return merge_totals(read_states(spark, f"{path}/libraries"), "sample_id", "library_size")
