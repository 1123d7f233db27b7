"""Count-matrix views of the test tables.

``counts``      lineitem as long counts: entity = part, sample = ship year and line status
``normalized``  ``counts`` after the low-count filter, CPM and log2
``wide``        lineitem as a wide matrix: one row per part, one column per return flag
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.operators.sizing import shared_dir
from tallytide.plans import normalize
from tallytide.sources import read_table, write_table

MIN_TOTAL = 500

_stages: dict[tuple[str, str, str], str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def stage_path(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]
) -> str:
    """The path of a stage file, written to the shared folder on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        path = scratch_path(spark, name)
        write(path)
        _stages[key] = path
    return _stages[key]


def forget_stages() -> None:
    """Make the next use write its stage tables anew."""
    _stages.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrs = (F.year("l_shipdate") - 1995).cast("int")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("gene_id"), hrs.alias("hrs"), F.col("l_linestatus").alias("rep")
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("n"))
        .select(
            "gene_id",
            F.concat_ws("-", F.col("hrs").cast("string"), "rep").alias("sample_id"),
            "hrs",
            "rep",
            "n",
        )
    )


def build_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(counts(spark, sf_dir), MIN_TOTAL, count="n", keep=("hrs", "rep"))


def _stage(
    spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    path = stage_path(
        spark,
        sf_dir,
        build.__name__,
        lambda to: write_table(
            build(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "gene_id"), to
        ),
    )
    return read_table(spark, path)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, sf_dir, build_counts)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, sf_dir, build_normalized)


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second binding: entity = user, sample = day and event type, count = events."""
    day = F.dayofyear("ts").cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("gene_id"), day.alias("hrs"), F.col("event_type").alias("rep"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("sample_id", F.concat_ws("-", F.col("hrs").cast("string"), "rep"))
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    flags = [r[0] for r in lines.select("l_returnflag").distinct().orderBy("l_returnflag").collect()]
    return (
        lines.groupBy(F.col("l_partkey").alias("gene_id"))
        .pivot("l_returnflag", flags)
        .agg(F.sum("l_quantity").cast("bigint"))
    )


def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).select("sample_id", "hrs", "rep").distinct()


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gene_id"),
        F.col("p_type").alias("process"),
        F.col("p_brand").alias("class"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def fixed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stated label per entity, so that cluster summaries can be checked without k-means."""
    return (
        normalized(spark, sf_dir)
        .select("gene_id")
        .distinct()
        .withColumn("cluster", F.pmod("gene_id", F.lit(5)).cast("int"))
    )
