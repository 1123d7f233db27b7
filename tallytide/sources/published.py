"""Tables that stay whole when a run dies while it writes.

Spark's overwrite deletes the old files before the new ones are written. ``publish_table`` writes each
run to a folder of its own and then adds one row to a list of finished ones; readers take the last
folder listed. A run that dies leaves a folder nobody reads. ``replace_partitions`` leaves partitions
it does not write as they are and moves the others in place when all tasks are done.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.operators.layout import layout_by_key
from tallytide.operators.sizing import key_list
from tallytide.sources.writers import write_table

MARKS = "finished"
MARK_SCHEMA = "version string, at bigint"


def _marks(spark: SparkSession, path: str) -> list[str]:
    """Folders of finished runs, oldest first."""
    try:
        marks = spark.read.schema(MARK_SCHEMA).parquet(f"{path}/{MARKS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r["version"] for r in marks.orderBy("at", "version").collect()]


def publish_table(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None) -> str:
    """Write ``df`` as the newest version of the table and return the version's name.

    ``df`` may read the table itself. Of two runs at once the one whose mark is later is read. Older
    versions stay for readers that began before; ``superseded`` lists them.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    write_table(df, f"{path}/{version}", partition_by)
    mark = spark.createDataFrame([(version, time.time_ns())], MARK_SCHEMA)
    mark.coalesce(1).write.mode("append").parquet(f"{path}/{MARKS}")
    return version


def read_published(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The newest finished version; without one this is an error."""
    finished = _marks(spark, path)
    if not finished:
        raise ValueError(f"{path}: no finished version")
    table = spark.read.parquet(f"{path}/{finished[-1]}")
    return table if columns is None else table.select(*columns)


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Paths of finished versions that a newer one replaced, oldest first."""
    return [f"{path}/{v}" for v in _marks(spark, path)[:-1]]


def replace_partitions(df: DataFrame, path: str, partition_by: str | Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, as with counts of some times read anew; the others
    stay. An empty ``df`` changes nothing. Rows are laid out as ``write_table`` does."""
    keys = key_list(partition_by)
    writer = layout_by_key(df, keys).write.mode("overwrite").partitionBy(*keys)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def partition_rows(spark: SparkSession, path: str, partition_by: str | Sequence[str]) -> DataFrame:
    """Rows of each partition, from file footers alone."""
    return spark.read.parquet(path).groupBy(*key_list(partition_by)).agg(F.count(F.lit(1)).alias("n_rows"))
