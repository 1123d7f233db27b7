"""Joining a fact table to a side whose size is measured, never assumed.

A side that fits the byte limit is broadcast and the fact table does not move. A larger one is
joined by shuffle, with the rows of heavy keys spread over several partitions.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions import quoted

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
HASHED_PARTITION_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48

_SPLITS = "__splits"
_PART = "__part"


class Settled(NamedTuple):
    """A table computed once, with its measured size."""

    table: DataFrame
    bytes: float
    rows: int


def key_list(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a local one is made only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="tallytide-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _row_bytes(df: DataFrame) -> str | None:
    """Expression for the bytes of one row, or None for a type that is not worth measuring."""
    terms = [f"{ROW_OVERHEAD_BYTES}L"]
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            terms.append(f"16 + coalesce(octet_length({quoted(field.name)}), 0)")
        elif isinstance(field.dataType, T.DecimalType):
            terms.append("24")
        elif isinstance(field.dataType, T.NumericType | T.BooleanType | T.DatetimeType):
            terms.append("8")
        else:
            return None
    return " + ".join(terms)


def settle(df: DataFrame | Settled) -> Settled:
    """Compute ``df`` once into a checkpoint and measure it on the way.

    Size and row count are observed while the checkpoint is written, so measuring costs no job of
    its own. The result has no lineage left to recompute when an executor is lost. A table with
    nested or vector columns counts as too large to broadcast.
    """
    if isinstance(df, Settled):
        return df
    shared_dir(df.sparkSession)
    width = _row_bytes(df)
    seen = Observation()
    table = df.observe(
        seen, F.expr("count(1) AS rows"), F.expr(f"sum({width or 0}) AS bytes")
    ).checkpoint()
    size = math.inf if width is None else seen.get["bytes"] or 0
    return Settled(table, size, seen.get["rows"])


def heavy_keys(weights: DataFrame, keys: Sequence[str], rows: str, partitions: int) -> DataFrame:
    """Keys holding more than one partition's share of all rows, with a number of splits each.

    ``weights`` has one row per key and its fact row count. At most ``partitions`` keys can exceed
    a share of 1/partitions, so the result is small whatever the data.
    """
    total = weights.agg(F.sum(rows)).first()[0] or 0
    share = total / partitions
    return weights.filter(F.col(rows) > share).select(
        *keys, F.ceil(2 * F.col(rows) / F.lit(share)).cast("int").alias(_SPLITS)
    )


def split_join(
    fact: DataFrame,
    side: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    weights: DataFrame | None = None,
    rows: str = "n_rows",
    side_bytes: float = math.inf,
) -> DataFrame:
    """Shuffle join in which each heavy key is spread over several partitions.

    A fact row of a heavy key gets a part number from a hash of the whole row and of the input
    partition it lies in, so a retried task repeats it and exact copies of one row spread too; the
    side rows of that key are copied once per part. Each fact row still meets each matching side row
    exactly once.

    Give ``side_bytes`` only for a side with one row per key, which spreads evenly: when it shows
    that a partition's share of the side is small, that is hashed in memory and the fact rows need
    no sort. Otherwise both sides are sorted, which can spill.
    """
    keys = key_list(on)
    spark = fact.sparkSession
    if weights is None:
        weights = settle(fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows))).table
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy, _, found = settle(heavy_keys(weights, keys, rows, partitions))
    method = "shuffle_hash" if side_bytes / partitions <= HASHED_PARTITION_BYTES else "merge"
    if not found:
        return fact.join(side.hint(method), keys, how)
    splits = F.coalesce(F.col(_SPLITS), F.lit(1))
    hashable = [f.name for f in fact.schema.fields if not isinstance(f.dataType, T.MapType)]
    row_hash = F.expr(_hash_of([*[quoted(c) for c in hashable], "spark_partition_id()"]))
    spread = broadcast_join(fact, heavy, keys, "left").withColumn(
        _PART, F.pmod(row_hash, splits).cast("int")
    )
    copies = broadcast_join(side, heavy, keys, "left").withColumn(
        _PART, F.explode(F.sequence(F.lit(0), splits - 1))
    )
    joined = spread.drop(_SPLITS).join(copies.drop(_SPLITS).hint(method), [*keys, _PART], how)
    return joined.drop(_PART)


def _collated(kind: T.DataType) -> bool:
    """Text that compares equal without being equal byte for byte, which a hash cannot know."""
    return isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY"


def _hash_of(columns: Sequence[str]) -> str:
    return f"xxhash64({', '.join(columns)})"


def broadcast_join(
    fact: DataFrame, side: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Broadcast join that looks rows up by one long, whatever the key columns are.

    Spark probes a table keyed by longs about ten times as fast as one keyed by text or by several
    columns. Other keys are therefore hashed to a long for the lookup, and the keys themselves are
    compared on the rows found, so two keys with one hash stay apart. The comparison is spelled as
    a pair of bounds because an equality would become part of the lookup key again. Keys of two
    different types or with a collation would hash differently and are left to Spark.
    """
    keys = key_list(on)
    types = [fact.schema[k].dataType for k in keys]
    whole = len(keys) == 1 and isinstance(types[0], T.IntegralType)
    if whole or any(_collated(t) for t in types) or types != [side.schema[k].dataType for k in keys]:
        return fact.join(F.broadcast(side), keys, how)
    mine = [quoted(k) for k in keys]
    theirs = [f"__key{i}" for i in range(len(keys))]
    added = [quoted(c) for c in side.columns if c not in keys]
    probe = fact.selectExpr("*", f"{_hash_of(mine)} AS __hash")
    build = side.selectExpr(
        *[f"{m} AS {t}" for m, t in zip(mine, theirs, strict=True)],
        *added,
        f"{_hash_of(mine)} AS __side",
    )
    bounds = [f"{m} >= {t} AND {m} <= {t}" for m, t in zip(mine, theirs, strict=True)]
    match = F.expr(" AND ".join(["__hash = __side", *bounds]))
    rest = [quoted(c) for c in fact.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        added = []
    return probe.join(F.broadcast(build), match, how).selectExpr(*mine, *rest, *added)


def lookup_join(
    fact: DataFrame,
    side: DataFrame | Settled,
    on: str | Sequence[str],
    how: str = "inner",
    rows: str | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """Join ``fact`` to a side table: broadcast if it measures small, else ``split_join``.

    ``rows`` names a column of a side with one row per key that already holds the number of fact
    rows per key, which spares the count of heavy keys; it is not part of the result. A side that
    is not settled yet costs one job. Columns other than the keys may not be on both sides, unless
    the join only filters.
    """
    keys = key_list(on)
    given = side.table if isinstance(side, Settled) else side
    shared = {*fact.columns} & {*given.columns} - {*keys, rows}
    if shared and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides of the join: {sorted(shared)}")
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    table, size, _ = settle(side)
    slim = table.drop(rows) if rows else table
    if size <= limit:
        return broadcast_join(fact, slim, keys, how)
    weights = table.select(*keys, rows) if rows else None
    hashed = size if rows else math.inf
    return split_join(fact, slim, keys, how, weights, rows or "n_rows", hashed)
