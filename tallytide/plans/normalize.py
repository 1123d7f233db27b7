"""Long counts to counts per million on the log2 scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallytide.functions import cpm, log2p1
from tallytide.operators.joins import attach_library_size, filter_low_count
from tallytide.operators.sizing import key_list


def normalize(
    counts: DataFrame,
    min_total: int | None = 10,
    entity: str = "gene_id",
    sample: str | Sequence[str] = "sample_id",
    count: str = "raw_count",
    keep: Sequence[str] = ("hours", "time_point", "replicate"),
) -> DataFrame:
    """Drop low-count entities, scale each sample to a million, take log2(x + 1).

    Library sizes are taken after the filter. With ``min_total=None`` nothing is dropped, library
    sizes cover every row, and the result is the input plus ``lib_size`` and ``log2_cpm``.

    Each of the two steps first settles a table with one row per entity or sample. While those
    measure small, the counts are read three times and never shuffled.
    """
    if min_total is None:
        sized = attach_library_size(counts, sample, count, "lib_size")
        return sized.withColumn("log2_cpm", log2p1(cpm(count, "lib_size")))
    kept = filter_low_count(counts, min_total, entity, count)
    scaled = attach_library_size(kept, sample, count).withColumn("cpm", cpm(count, "library_size"))
    return scaled.select(
        entity, *key_list(sample), *keep, count, "cpm", log2p1("cpm").alias("log2_cpm")
    )
