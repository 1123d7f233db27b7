"""Distinct entities by sketches that merge: counts of classes roll up to processes, times and the whole,
and counts of batches to those of all batches, without reading the rows again.

A sketch is a binary of at most ``2 ** lg_k`` bytes and a little more, whatever it has seen. Plain
distinct counts do not roll up, since an entity may stand in several classes and times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions import quoted

LG_K = 12
SKETCH = "sketch"


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The bound of an estimate's relative error at so many standard deviations, for merged sketches:
    1.04 / sqrt(2 ** lg_k) each, which is 4.9 % at the defaults."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def _hashable(rows: DataFrame, entity: str) -> Column:
    """Sketches take integers, text and binary; other kinds go in as text."""
    kind = rows.schema[entity].dataType
    plain = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)
    return F.col(quoted(entity)) if isinstance(kind, plain) else F.col(quoted(entity)).cast("string")


def entity_sketches(
    rows: DataFrame, keys: Sequence[str], entity: str = "gene_id", lg_k: int = LG_K
) -> DataFrame:
    """(keys, sketch): the distinct entities of each group. Null entities are not counted; without
    ``keys`` one row stands for all rows. Tasks send a sketch per group, so a group that holds most rows
    is no heavier than another."""
    return rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.hll_sketch_agg(_hashable(rows, entity), lg_k).alias(SKETCH)
    )


def roll_up(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, or of the same groups over several batches. Sketches of another
    ``lg_k`` are an error."""
    return sketches.groupBy(*[quoted(k) for k in keys]).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimates(
    sketches: DataFrame, out: str = "n_genes", lg_k: int = LG_K, deviations: float = 3.0
) -> DataFrame:
    """The sketch column replaced by ``out`` and its bounds ``out_low`` and ``out_high``."""
    found = F.col(out).cast("double")
    error = relative_error(lg_k, deviations)
    return (
        sketches.withColumn(out, F.coalesce(F.hll_sketch_estimate(SKETCH), F.lit(0)))
        .withColumn(f"{out}_low", F.floor(found / (1 + error)))
        .withColumn(f"{out}_high", F.ceil(found / (1 - error)))
        .drop(SKETCH)
    )
