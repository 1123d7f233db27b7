"""Stage tables to Parquet, result tables to CSV or Parquet, written by the tasks that hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallytide.operators.layout import layout_by_key
from tallytide.operators.sizing import key_list


def write_table(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None) -> None:
    """Overwrite a Parquet table.

    With ``partition_by`` rows are first gathered by that key, so a folder gets few files, and a
    key with very many rows gets several of them.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    keys = key_list(partition_by)
    layout_by_key(df, keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Overwrite a result table; CSV gets a header line per file."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
