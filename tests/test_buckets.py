"""A table in buckets is grouped and joined on its key without moving rows."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_text, rows
from tallytide.operators.aggregates import entity_totals, entity_variability
from tallytide.operators.joins import attach_baseline, filter_low_count
from tallytide.sources.buckets import bucket_skew, read_bucketed, write_bucketed


def counts(spark):
    return spark.range(4000).selectExpr(
        "id % 500 AS gene_id", "concat('s', id % 8) AS sample_id", "CAST(id % 3 AS int) AS hours",
        "id % 17 AS raw_count", "CAST(id % 17 AS double) AS log2_cpm",
    )


def test_grouping_needs_no_exchange(spark, tmp_path):
    df, path = counts(spark), str(tmp_path / "b")
    write_bucketed(df, path, "gene_id", 8)
    found = read_bucketed(spark, path, "gene_id", 8)
    for operator in (entity_totals, entity_variability):
        assert "Exchange" not in plan_text(operator(found))
        ours, theirs = rows(operator(found)), rows(operator(df))
        assert len(ours) == len(theirs)
        assert all(a == pytest.approx(b) for a, b in zip(ours, theirs, strict=True))
    assert "Exchange" in plan_text(entity_totals(df))


def test_joins_on_the_key_leave_the_rows_where_they_are(spark, tmp_path):
    df, path = counts(spark), str(tmp_path / "j")
    write_bucketed(df, path, "gene_id", 8)
    found = read_bucketed(spark, path, "gene_id", 8)
    joined = found.join(entity_totals(found).hint("merge"), "gene_id")
    assert "Exchange" not in plan_text(joined)
    assert joined.count() == 4000
    assert rows(filter_low_count(found, 60)) == rows(filter_low_count(df, 60))
    assert rows(attach_baseline(found, value="log2_cpm")) == rows(attach_baseline(df, value="log2_cpm"))


def test_another_session_knows_the_layout(spark, tmp_path):
    df, path = counts(spark), str(tmp_path / "s")
    write_bucketed(df, path, "gene_id", 4)
    for table in spark.catalog.listTables():
        if table.name.startswith("tallytide_"):
            spark.sql(f"DROP TABLE {table.name}")  # external: its files stay
    found = read_bucketed(spark.newSession(), path, "gene_id", 4)
    assert "Exchange" not in plan_text(entity_totals(found))
    assert found.count() == 4000


def test_a_hot_key_gives_no_buckets(spark, tmp_path):
    df = counts(spark).withColumn("gene_id", F.when(F.col("gene_id") < 250, 1).otherwise(F.col("gene_id")))
    path = str(tmp_path / "hot")
    assert bucket_skew(df, "gene_id", 16) > 4
    write_bucketed(df, path, "gene_id", 16)
    found = read_bucketed(spark, path, "gene_id", 16)
    assert "Exchange" in plan_text(entity_totals(found))
    assert rows(entity_totals(found)) == rows(entity_totals(df))


def test_an_empty_table_and_no_buckets(spark, tmp_path):
    path = str(tmp_path / "none")
    write_bucketed(counts(spark).limit(0), path, "gene_id", 4)
    assert read_bucketed(spark, path, "gene_id", 4).count() == 0
    with pytest.raises(ValueError, match="bucket"):
        write_bucketed(counts(spark), path, "gene_id", 0)
