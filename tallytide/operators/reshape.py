"""Between wide, long and vector form."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallytide.functions import element, quoted, to_count
from tallytide.operators.joins import present_samples
from tallytide.operators.sizing import Settled, broadcast_join, lookup_join


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the columns named by the mapping's keys under its values."""
    return df.select(*[F.col(quoted(old)).alias(new) for old, new in mapping.items()])


def select_known_samples(
    matrix: DataFrame,
    metadata: DataFrame,
    entity: str = "gene_id",
    sample: str = "sample_id",
) -> DataFrame:
    """The entity column and the sample columns the metadata knows, in matrix order.

    The match runs as a join against the header, so what comes back to the driver is no longer
    than the header, however many samples the metadata lists.
    """
    candidates = [c for c in matrix.columns if c != entity]
    header = present_samples(matrix.sparkSession, candidates, sample)
    hits = broadcast_join(metadata.select(sample), header, sample, "left_semi").distinct()
    known = {row[0] for row in hits.collect()}
    return matrix.selectExpr(quoted(entity), *[quoted(c) for c in candidates if c in known])


def melt_matrix(
    df: DataFrame,
    entity: str = "gene_id",
    columns: Sequence[str] | None = None,
    sample: str = "sample_id",
    count: str = "raw_count",
) -> DataFrame:
    """Wide to long: one row per entity and sample column, null cells included.

    The cells of a row become one array that is exploded with positions. ``unpivot`` gives the
    same rows but plans one projection of the whole row per column, so its cost grows with the
    square of the width. Names are one JSON literal, so they are never parsed as SQL.
    """
    values = [c for c in df.columns if c != entity] if columns is None else list(columns)
    names = F.from_json(F.lit(json.dumps(values)), "array<string>")
    cells = F.expr(f"posexplode(array({', '.join(quoted(c) for c in values)}))")
    return df.select(F.col(quoted(entity)), cells.alias("__pos", count)).select(
        F.col(quoted(entity)), F.get(names, "__pos").alias(sample), F.col(quoted(count))
    )


def clean_counts(long: DataFrame, count: str = "raw_count") -> DataFrame:
    """Drop blank cells, then turn counts into longs; malformed cells stay as null."""
    return long.filter(F.col(count).isNotNull()).withColumn(count, to_count(count))


def fill_missing(df: DataFrame, value: float = 0.0) -> DataFrame:
    return df.fillna(value)


def pivot_values(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence,
    value: str,
    agg=F.max,
    fill: float | None = None,
) -> DataFrame:
    """Long to wide with one column per listed value, aggregated before the shuffle."""
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(agg(value))
    if fill is None:
        return wide
    names = [c for c in wide.columns if c not in keys]
    return wide.fillna(fill, subset=[quoted(c) for c in names])


def pivot_samples(
    normalized: DataFrame,
    entities: Sequence,
    keys: Sequence[str] = ("sample_id", "hours", "replicate"),
    entity: str = "gene_id",
    value: str = "log2_cpm",
    fill: float = 0.0,
) -> DataFrame:
    """Sample by entity matrix. For more than a few hundred entities use ``long_to_vector``."""
    return pivot_values(normalized, keys, entity, entities, value, F.max, fill)


def pivot_time(
    means: DataFrame,
    times: Sequence[int],
    entity: str = "gene_id",
    t: str = "hours",
    value: str = "mean_log2_cpm",
    fill: float = 0.0,
) -> DataFrame:
    """Entity by time matrix of means."""
    return pivot_values(means, [entity], t, times, value, F.max, fill)


def assemble(
    df: DataFrame, columns: Sequence[str], out: str = "features", nulls: str = "error"
) -> DataFrame:
    """Numeric columns to one vector.

    Nulls must be filled first, or kept with ``nulls="keep"``: their slots then hold NaN.
    """
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=nulls).transform(df)


def feature_index(features: DataFrame, feature: str, order: Sequence[Column]) -> DataFrame:
    """Number a feature list from 0 in the given order.

    The list is the chosen feature set, which also has to fit one dense vector, so ordering it in
    one task is bounded by the vector length.
    """
    position = F.row_number().over(Window.orderBy(*order)) - 1
    return features.select(feature, position.cast("int").alias("__idx"))


def long_to_vector(
    df: DataFrame,
    key: Sequence[str],
    feature: str,
    value: str,
    index: DataFrame | Settled,
    size: int,
    out: str = "features",
    fill: float = 0.0,
) -> DataFrame:
    """Dense vector per key from long rows, without a pivot column per feature.

    ``index`` maps a feature to its slot ``__idx`` (see ``feature_index``). Rows are first reduced
    to one per key and feature, so a list holds at most ``size`` entries whatever the number of
    rows behind a key. Slots without a row, or with a null, get ``fill``.
    """
    blank = F.lit(float(fill))
    entries = F.sort_array(F.collect_list(F.struct("__idx", "__val")))

    def with_gap(entry: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col("__entries"), i - 1)["__idx"], F.lit(-1))
        return F.concat(
            F.array_repeat(blank, entry["__idx"] - before - 1), F.array(entry["__val"])
        )

    tail = F.array_repeat(blank, F.lit(size - 1) - F.element_at("__entries", -1)["__idx"])
    gapped = F.concat(F.flatten(F.transform("__entries", with_gap)), tail)
    slots = F.when(F.size("__entries") == size, F.col("__entries.__val")).otherwise(gapped)
    return (
        lookup_join(df.select(*key, feature, value), index, feature)
        .groupBy(*key, "__idx")
        .agg(F.coalesce(F.max(value), blank).alias("__val"))
        .groupBy(*key)
        .agg(entries.alias("__entries"))
        .select(*key, array_to_vector(slots).alias(out))
    )


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The leading elements of a vector as named double columns, in place of the vector."""
    return (
        df.withColumn("__array", vector_to_array(vector))
        .withColumns({name: element("__array", i) for i, name in enumerate(names)})
        .drop("__array", vector)
    )
