"""Distinct, copies and difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def replicate_rows(df: DataFrame, n: int, out: str = "replica") -> DataFrame:
    """n numbered copies of every row from one scan of the input.

    Use ``(sample, replica)`` as the sample key afterwards, or copies share a library.
    """
    if n < 1:
        raise ValueError(f"need at least one copy, not {n}")
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks, with multiplicity."""
    return a.exceptAll(b)
