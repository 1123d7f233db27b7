"""CSV and Parquet in. CSV is read as strings and cast by name, never inferred."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions import quoted, to_int

# Metadata file header -> column name.
METADATA_COLUMNS = {
    "sample": "full_sample_name",
    "replicate": "replicate",
    "time": "time_point",
    "hours": "hours",
    "time_label": "time_label",
    "sample_ID": "sample_id",
}

# Annotation file header -> column name.
ANNOTATION_COLUMNS = {
    "Symbol": "Symbol",
    "FlyBaseID": "gene_id",
    "Functional Class": "functional_class",
    "Immune Process": "immune_process",
}

#: Headers of files of at most so many bytes are read together.
SMALL_FILE = 128 << 20


def _header_lines(spark: SparkSession, path: str, up_to: int) -> list[tuple[str, list[str]]]:
    """Distinct first lines of the files of at most ``up_to`` bytes, each with its files, from one job
    that reads text and parses nothing."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"),
    )
    firsts = (
        lines.filter((F.col("size") <= up_to) & F.col("value").rlike(r"[^\x00-\x20]"))
        .groupBy("file")
        .agg(F.min_by("value", F.struct("start", "at")).alias("line"))
    )
    grouped = firsts.groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [(r["line"], [unquote(f) for f in r["files"]]) for r in grouped.collect()]


def _headers(spark: SparkSession, path: str) -> dict[tuple[str | None, ...], list[str]]:
    """The files below ``path`` by their header; files need not share one column order.

    Files of at most ``SMALL_FILE`` bytes are read together in one job, however many there are; of a larger file a
    job reads the first line.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    found = []
    for line, files in _header_lines(spark, path, SMALL_FILE):
        cells = spark.range(1).select(F.schema_of_csv(F.lit(line)).alias("kind"))
        width = len(T.StructType.fromDDL(cells.first()["kind"]))
        text = ", ".join(f"_c{i} string" for i in range(width))
        found.append((files, spark.range(1).select(F.from_csv(F.lit(line), F.lit(text))).first()[0]))
    for row in listed.filter(F.col("length") > SMALL_FILE).collect():
        found.append(([row["path"]], spark.read.csv(row["path"], header=False, inferSchema=False).first()))
    by_header: dict[tuple[str | None, ...], list[str]] = {}
    for files, header in sorted(found, key=lambda f: f[0]):
        if header is not None:
            by_header.setdefault(tuple(header), []).extend(files)
    if not by_header:
        raise ValueError(f"{path}: no header line")
    return by_header


def _read_named(spark: SparkSession, files: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Files of one header as text columns. A row with more or fewer cells than the header fails the
    read with the file's name; pruned columns would hide it."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("columnPruning", "false")
    return reader.csv(list(files), header=True, enforceSchema=True)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _read_mapped(spark: SparkSession, path: str, mapping: Mapping[str, str]) -> DataFrame:
    parts = []
    for header, files in _headers(spark, path).items():
        names = [c or f"_c{i}" for i, c in enumerate(header)]
        absent = [c for c in mapping if c not in names]
        if absent:
            raise ValueError(f"{files[0]}: no column {absent}; the header has {names}")
        raw = _read_named(spark, files, [f"{i}" for i in range(len(names))])
        parts.append(
            raw.select(*[F.col(quoted(f"{names.index(old)}")).alias(new) for old, new in mapping.items()])
        )
    return _union(parts)


def read_sample_metadata(
    spark: SparkSession,
    path: str,
    mapping: Mapping[str, str] = METADATA_COLUMNS,
    int_cols: Sequence[str] = ("time_point", "hours"),
) -> DataFrame:
    """One row per sample. Lines may end in LF, CRLF or a bare CR."""
    named = _read_mapped(spark, path, mapping)
    return named.withColumns({c: to_int(c) for c in int_cols})


def read_annotation(
    spark: SparkSession, path: str, mapping: Mapping[str, str] = ANNOTATION_COLUMNS
) -> DataFrame:
    return _read_mapped(spark, path, mapping)


def read_count_matrix(spark: SparkSession, path: str, entity: str = "gene_id") -> DataFrame:
    """Wide matrix of strings, one row per entity and one column per sample.

    The first column is renamed by position, as its header is often blank; the others go by name, so
    the files of a folder may order them differently but must have the same ones. A repeated sample
    name is an error: Spark would number the repeats and they would later look like unknown samples.
    """
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    parts: list[DataFrame] = []
    for header, files in _headers(spark, path).items():
        names = [entity, *[c for c in header[1:] if c is not None]]
        seen = Counter(names if sensitive else [c.lower() for c in names])
        repeated = [c for c in names if seen[c if sensitive else c.lower()] > 1]
        if repeated:
            raise ValueError(f"{files[0]}: repeated column names {repeated}")
        labels = [entity, *[c or f"_c{i}" for i, c in enumerate(header[1:], start=1)]]
        part = _read_named(spark, files, labels)
        if parts and {*part.columns} != {*parts[0].columns}:
            other = sorted({*part.columns} ^ {*parts[0].columns})
            raise ValueError(f"{files[0]}: columns that not all files have: {other}")
        parts.append(part)
    return _union(parts)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if columns is None else table.select(*columns)
