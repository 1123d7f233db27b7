"""Matrix and metadata to long counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallytide.operators.joins import attach_metadata
from tallytide.operators.quality import require_unique
from tallytide.operators.reshape import clean_counts, melt_matrix, select_known_samples
from tallytide.operators.sizing import Settled, settle
from tallytide.sources.readers import read_count_matrix, read_sample_metadata, read_table
from tallytide.sources.writers import write_table

SAMPLE_COLUMNS = ("hours", "time_point", "replicate", "time_label")


def ingest_long(
    long: DataFrame,
    metadata: DataFrame | Settled,
    sample: str = "sample_id",
    count: str = "raw_count",
    columns: Sequence[str] = SAMPLE_COLUMNS,
) -> DataFrame:
    """Clean long text counts and add the sample columns."""
    return attach_metadata(clean_counts(long, count), metadata, sample, columns)


def ingest(
    matrix: DataFrame,
    metadata: DataFrame,
    entity: str = "gene_id",
    sample: str = "sample_id",
    count: str = "raw_count",
    columns: Sequence[str] = SAMPLE_COLUMNS,
    check_keys: bool = True,
) -> DataFrame:
    """Wide matrix to one row per entity and known sample, blank cells left out.

    Keys are checked on the two inputs, where that reads one row per entity and one per sample;
    together with distinct column names this makes (entity, sample) unique in the result.
    """
    samples = settle(metadata.select(sample, *columns))
    if check_keys:
        require_unique(samples.table, sample, "metadata")
        require_unique(matrix, entity, "matrix")
    known = select_known_samples(matrix, samples.table, entity, sample)
    long = melt_matrix(known, entity, None, sample, count)
    return ingest_long(long, samples, sample, count, columns)


def ingest_files(
    spark: SparkSession,
    matrix_path: str,
    metadata_path: str,
    out_path: str,
    partition_by: str | None = "hours",
    check_keys: bool = True,
) -> DataFrame:
    """Read both CSV files, write the long counts as Parquet and return that table."""
    counts = ingest(
        read_count_matrix(spark, matrix_path),
        read_sample_metadata(spark, metadata_path),
        check_keys=check_keys,
    )
    write_table(counts, out_path, partition_by)
    return read_table(spark, out_path)
