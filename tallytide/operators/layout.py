"""Data layout and reuse."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tallytide.operators.sizing import key_list


def layout_by_key(df: DataFrame, key: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Bring rows of a key together, starting from ``n`` partitions.

    This is a rebalance, not a plain hash repartition: adaptive execution splits the partition of
    a key that holds a large share of the rows and merges small ones.
    """
    keys = key_list(key)
    return df.hint("rebalance", *([n] if n else []), *keys)


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Even out partition sizes, to exactly ``n`` partitions if given."""
    return df.repartition(n) if n else df.hint("rebalance")


@contextmanager
def persist_scope(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER
) -> Iterator[DataFrame]:
    """Keep ``df`` for the block and release it afterwards, also when the block raises."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
