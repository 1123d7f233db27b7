"""A corpus prepared for training: language, exact and near duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm.common import table, written
from tallytide.llm.exact_dedup import drop_exact_duplicates
from tallytide.llm.language import keep_identified
from tallytide.llm.mixing import layout_topic, sample_mix, word_count
from tallytide.llm.packing import pack
from tallytide.llm.simhash import drop_near_duplicates
from tallytide.llm.tokens import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of text that a Python worker gets at once. Spark's default is 64 MB, which the worker, its
#: copy of the rows it keeps and the buffers of the executor each hold. A longer text goes alone.
BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """Sets the size of Arrow batches for the session; stages are run after they are returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go."""
    small_batches(spark)
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the row with the smallest id stays."""
    small_batches(spark)
    return drop_near_duplicates(docs, words=4, max_bits=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics come near their target shares."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}
    return sample_mix(docs, dims, word_count(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    small_batches(spark)
    return pack(docs, vocabulary("byte_bpe_50k.json"), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Language scores, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
