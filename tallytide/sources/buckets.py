"""Parquet tables laid out by a key, so that grouping and joining on it moves no rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.functions import quoted

#: A bucket of more than this many times the mean makes the table be read as if it had none.
UNEVEN = 4.0


def _table_name(path: str, buckets: int) -> str:
    return f"tallytide_{hashlib.sha256(f'{path}#{buckets}'.encode()).hexdigest()[:24]}"


def bucket_skew(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the fullest bucket as a multiple of the mean; 0 without rows. One job, combined in
    the map tasks."""
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    return most * buckets / rows if rows else 0.0


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Overwrite a Parquet table with one sorted file per bucket of ``key``.

    If some bucket would hold more than ``UNEVEN`` times the mean, a key with a large share of the
    rows is among them: rows then are spread evenly over as many files and the table has no buckets,
    since a bucket is read by one task. Operators shuffle it as any other table. So is a table
    without rows.
    """
    if buckets < 1:
        raise ValueError("a table has one bucket or more")
    spark, name = df.sparkSession, _table_name(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    skew = bucket_skew(df, key, buckets)
    if not skew or skew > UNEVEN:
        df.repartition(buckets).write.mode("overwrite").parquet(path)
        return
    rows = df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed`` with its layout, in any session; ``key`` and ``buckets`` are
    those it was written with. One written without buckets is read as plain Parquet.

    Only a file's name tells its bucket, so the layout is told by the names of the files.
    """
    plain = spark.read.parquet(path)
    name = F.element_at(F.split(F.col("_metadata.file_name"), r"\."), 1)
    listed = plain.select(F.regexp_like(name, F.lit(r"_\d{5}$")).alias("in_bucket"))
    first = listed.first()
    if first is None or not first[0]:
        return plain
    table = _table_name(path, buckets)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in plain.schema)
    at = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({quoted(key)}) "
        f"SORTED BY ({quoted(key)}) INTO {buckets} BUCKETS LOCATION '{at}'"
    )
    return spark.table(table)
