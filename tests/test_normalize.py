import math

import pytest
from helpers import long_counts, rows
from pyspark.sql import functions as F

from tallytide.operators.joins import attach_library_size, filter_low_count
from tallytide.operators.sets import replicate_rows
from tallytide.plans import normalize

CELLS = [
    ("a", "1A", 0, 10), ("b", "1A", 0, 30), ("c", "1A", 0, 4),
    ("a", "2A", 5, 70), ("b", "2A", 5, 0), ("c", "2A", 5, 5),
    ("a", "2B", 5, 20), ("b", "2B", 5, 20), ("c", "2B", 5, 0),
]


def test_columns_and_values(spark):
    out = normalize(long_counts(spark, CELLS))
    assert out.columns == [
        "gene_id", "sample_id", "hours", "time_point", "replicate", "raw_count", "cpm", "log2_cpm",
    ]
    got = {(r.gene_id, r.sample_id): (r.cpm, r.log2_cpm) for r in out.collect()}
    assert set(got) == {(g, s) for g, s, _, _ in CELLS if g != "c"}
    assert got["a", "1A"] == pytest.approx((250000.0, math.log2(250001)))
    assert got["b", "2A"] == (0.0, 0.0)
    per_sample = out.groupBy("sample_id").agg(F.sum("cpm").alias("s")).collect()
    assert all(r.s == pytest.approx(1e6) for r in per_sample)


def test_library_size_before_or_after_the_filter(spark):
    counts = long_counts(spark, CELLS)
    unfiltered = normalize(counts, None)
    assert unfiltered.columns[-2:] == ["lib_size", "log2_cpm"]
    assert dict(rows(unfiltered.select("sample_id", "lib_size").distinct()))["1A"] == 44
    filtered = normalize(counts).filter("sample_id = '1A'")
    assert filtered.agg(F.sum("raw_count")).first()[0] == 40


def test_boundary_totals(spark):
    cells = [("g9", "1A", 0, 9), ("g10", "1A", 0, 10), ("g11", "1A", 0, 11), ("gn", "1A", 0, None)]
    kept = filter_low_count(long_counts(spark, cells), 10)
    assert rows(kept, "gene_id") == [("g10",), ("g11",)]


def test_empty_library_gives_null(spark):
    cells = [("a", "1A", 0, 0), ("b", "1A", 0, 0), ("a", "2A", 1, 30), ("b", "2A", 1, 20)]
    out = normalize(long_counts(spark, cells))
    assert rows(out.filter("sample_id = '1A'"), "cpm", "log2_cpm") == [(None, None)] * 2
    assert out.filter("sample_id = '2A' and log2_cpm is null").count() == 0


def test_scaling_one_sample_changes_nothing(spark):
    counts = long_counts(spark, CELLS)
    doubled = counts.withColumn(
        "raw_count", F.when(F.col("sample_id") == "2A", 2 * F.col("raw_count")).otherwise(F.col("raw_count"))
    )
    keys = ["gene_id", "sample_id", F.round("log2_cpm", 9).alias("v")]
    assert rows(normalize(counts, None).select(*keys)) == rows(normalize(doubled, None).select(*keys))


def test_input_split_does_not_matter(spark):
    counts = long_counts(spark, CELLS)
    keys = ["gene_id", "sample_id", F.round("log2_cpm", 9).alias("v")]
    want = rows(normalize(counts).select(*keys))
    for n in (1, 3, 11):
        assert rows(normalize(counts.repartition(n)).select(*keys)) == want


def test_copies_keep_their_own_libraries(spark):
    counts = long_counts(spark, CELLS)
    copies = replicate_rows(counts, 4)
    out = normalize(copies, None, sample=["sample_id", "replica"])
    one = rows(normalize(counts, None), "gene_id", "sample_id", "lib_size", "log2_cpm")
    for replica in range(4):
        part = out.filter(F.col("replica") == replica)
        assert rows(part, "gene_id", "sample_id", "lib_size", "log2_cpm") == one


def test_library_size_overflow_raises(spark):
    cells = [("a", "1A", 0, 2**62), ("b", "1A", 0, 2**62)]
    with pytest.raises(Exception, match="(?i)overflow"):
        attach_library_size(long_counts(spark, cells)).collect()
