"""Key and cell checks, run where they are cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.functions import quoted, to_count
from tallytide.operators.sizing import key_list


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    columns = [F.col(quoted(k)) for k in key_list(keys)]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: str | Sequence[str], what: str) -> None:
    """Raise if a key repeats; duplicates would silently change sums and means."""
    sample = duplicate_keys(df, keys).take(3)
    if sample:
        raise ValueError(f"{what}: duplicate keys {[tuple(r)[:-1] for r in sample]}")


def cell_report(long: DataFrame, count: str = "raw_count") -> DataFrame:
    """One row: cells, blank cells, and cells with text that is no number."""
    blank = F.col(count).isNull()
    return long.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & to_count(count).isNull()).alias("malformed"),
    )


def without_baseline(
    means: DataFrame, baseline: int = 0, entity: str = "gene_id", t: str = "hours"
) -> DataFrame:
    """One row: entities, and how many lack a row at the baseline time."""
    per_entity = means.groupBy(entity).agg(F.max(F.col(t) == baseline).alias("has"))
    return per_entity.agg(
        F.count(F.lit(1)).alias("n_entities"), F.count_if(~F.col("has")).alias("n_dropped")
    )
