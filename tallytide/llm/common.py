"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.operators.sizing import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into a Parquet table of the shared folder and read from there.

    A later stage that loses an executor reads the table again instead of repeating its lineage.
    The tables stay until ``clear_scratch`` or until the shared folder is emptied.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def driver_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small table of rows that the driver holds.

    It goes to Spark as Arrow and is a part of the plan. Rows given as Python objects would be read by
    Python workers, which stay on the executors long after.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [pa.array([row[i] for row in rows]) for i in range(len(fields))]
    return spark.createDataFrame(pa.table(columns, fields.names), fields)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every table this application wrote; frames that read them are void afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` would also change other scripts."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def training_part(doc_id: str) -> Column:
    """False for the third of the ids held out of learning; null ids are not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values and the seed only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))
