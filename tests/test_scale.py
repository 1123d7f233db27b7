"""What keeps the operators sound on big and lopsided data: plans, size checks, heavy keys."""

import pytest
from helpers import long_counts, plan_text, rows
from pyspark.sql import functions as F

from tallytide.operators import sizing
from tallytide.operators.joins import annotate, filter_low_count, restrict_to
from tallytide.operators.layout import layout_by_key, persist_scope, rebalance
from tallytide.operators.ml import standardize
from tallytide.operators.ranking import time_axis, top_variable
from tallytide.operators.sets import replicate_rows
from tallytide.operators.sizing import broadcast_join, heavy_keys, lookup_join, settle, split_join
from tallytide.plans import fold_change, normalize, sample_vectors
from tallytide.sources import write_table
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every side counts as too large, for this library and for Spark's own planner."""
    monkeypatch.setattr(sizing, "BROADCAST_LIMIT_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def lopsided(spark):
    """30,000 rows over 300 keys; one key holds a third of them, one is null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 1001 == 7, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 299).cast("string")))
    )
    return settle(spark.range(30_000).select(key.alias("k"), "id")).table


@pytest.fixture(scope="module")
def dimension(spark):
    names = ["hot", "hot", *[f"k{i}" for i in range(250)], "unused"]
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, v int")


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti", "left"])
def test_split_and_broadcast_joins_equal_the_plain_join(spark, no_broadcast, lopsided, dimension, how):
    want = rows(lopsided.join(dimension, "k", how), "k", "id")
    assert rows(split_join(lopsided, dimension, "k", how), "k", "id") == want
    assert rows(lookup_join(lopsided, dimension, "k", how), "k", "id") == want
    assert rows(broadcast_join(lopsided, dimension, "k", how), "k", "id") == want


def test_several_keys_of_several_types(spark, no_broadcast, lopsided):
    fact = lopsided.withColumns({"a.b": F.col("id") % 5, "q": F.col("id").cast("int") % 2})
    side = fact.select("k", "`a.b`", "q").distinct().filter("q = 0").withColumn("w", F.lit(1.5))
    keys = ["k", "a.b", "q"]
    want = rows(fact.filter("q = 0 and k is not null"), "id")
    assert rows(broadcast_join(fact, side, keys), "id") == want
    long_q = side.withColumn("q", F.col("q").cast("long"))
    assert rows(broadcast_join(fact.drop("a.b"), long_q.drop("a.b").distinct(), ["k", "q"]), "id") == want


def test_equal_hashes_do_not_match(spark, monkeypatch, lopsided, dimension):
    want = rows(lopsided.join(dimension, "k"), "k", "id", "v")
    monkeypatch.setattr(sizing, "_hash_of", lambda columns: "1L")
    assert rows(broadcast_join(lopsided, dimension, "k"), "k", "id", "v") == want


def test_heavy_keys_are_few_and_found(spark, lopsided):
    weights = lopsided.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    heavy = rows(heavy_keys(weights, ["k"], "n_rows", 8))
    assert [k for k, _ in heavy] == ["hot"]
    assert heavy[0][1] >= 5
    for partitions in (1, 4, 64, 1000):
        assert heavy_keys(weights, ["k"], "n_rows", partitions).count() <= partitions


def test_heavy_rows_spread_over_partitions(spark, no_broadcast, lopsided, dimension):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = split_join(lopsided, dimension.dropDuplicates(["k"]), "k")
        hot = joined.withColumn("task", F.spark_partition_id()).filter("k = 'hot'")
        per_task = hot.groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) >= 3
    assert max(r["count"] for r in per_task) < 8_000


def test_large_sides_give_the_same_pipelines(spark, no_broadcast):
    counts = fx.counts(spark, SF)
    ann = fx.annotation(spark, SF)
    got = {
        "normalize": rows(normalize(counts, 500, count="n", keep=("hrs", "rep")), "gene_id", "sample_id", F.round("log2_cpm", 9)),
        "annotate": rows(annotate(counts, ann)),
        "restrict": rows(restrict_to(counts, ann.filter("class = 'Brand#11'"))),
        "z": rows(standardize(counts, "sample_id", "n"), "gene_id", "sample_id", F.round("z", 9)),
    }
    sizing.BROADCAST_LIMIT_BYTES = 1 << 30
    want = {
        "normalize": rows(normalize(counts, 500, count="n", keep=("hrs", "rep")), "gene_id", "sample_id", F.round("log2_cpm", 9)),
        "annotate": rows(annotate(counts, ann)),
        "restrict": rows(restrict_to(counts, ann.filter("class = 'Brand#11'"))),
        "z": rows(standardize(counts, "sample_id", "n"), "gene_id", "sample_id", F.round("z", 9)),
    }
    assert got == want


def test_measured_size_decides(spark):
    side = spark.range(1000).select(F.col("id").alias("gene_id"), F.lit("x" * 100).alias("s"))
    assert 150_000 < settle(side).bytes < 400_000
    fact = fx.counts(spark, SF)
    assert "BroadcastHashJoin" in plan_text(lookup_join(fact, side, "gene_id"))
    assert "SortMergeJoin" in plan_text(lookup_join(fact, side, "gene_id", limit_bytes=100_000))
    counted = side.withColumn("n_rows", F.lit(12))
    unique = lookup_join(fact, counted, "gene_id", rows="n_rows", limit_bytes=100_000)
    assert "ShuffledHashJoin" in plan_text(unique) and "n_rows" not in unique.columns
    assert settle(side).rows == 1000


def test_nested_columns_are_never_broadcast(spark):
    assert settle(spark.range(3).select(F.array("id").alias("a"))).bytes == float("inf")
    assert settle(spark.range(0)).bytes == 0


def test_normalise_does_not_shuffle_the_counts(spark):
    plan = plan_text(normalize(fx.counts(spark, SF), 500, count="n", keep=("hrs", "rep")))
    assert "LeftSemi" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "ReadSchema: struct<gene_id:bigint,sample_id:string,hrs:int,rep:string,n:bigint>" in plan


def test_low_count_filter_reads_two_columns_first(spark):
    totals = fx.counts(spark, SF).groupBy("gene_id").agg(F.sum("n"))
    assert "ReadSchema: struct<gene_id:bigint,n:bigint>" in plan_text(totals)
    assert "LeftSemi" in plan_text(filter_low_count(fx.counts(spark, SF), 500, count="n"))


def test_few_failing_entities_are_broadcast_instead(spark, monkeypatch):
    counts = fx.counts(spark, SF)
    holes = counts.union(counts.limit(1).withColumn("gene_id", F.lit(None).cast("bigint")))
    blank = counts.limit(1).withColumns({"gene_id": F.lit(-1).cast("bigint"), "n": F.lit(None).cast("bigint")})
    fact = settle(holes.union(blank)).table
    want = rows(filter_low_count(fact, 500, count="n"))
    monkeypatch.setattr(sizing, "BROADCAST_LIMIT_BYTES", 2000)
    few = filter_low_count(fact, 500, count="n")
    assert "LeftAnti" in plan_text(few) and "hashpartitioning" not in plan_text(few)
    assert rows(few) == want


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_text(top_variable(fx.normalized(spark, SF), 20))


def test_later_times_are_pushed_to_the_scan(spark):
    plan = plan_text(fold_change(fx.normalized(spark, SF), baseline=3, t="hrs", also=()))
    assert "GreaterThanOrEqual(hrs,3)" in plan


def test_copies_come_from_one_scan(spark):
    plan = plan_text(replicate_rows(fx.counts(spark, SF), 10))
    assert plan.count("ReadSchema") == 1 and "Join" not in plan and "Union" not in plan


def test_vectors_need_no_pivot_column_per_feature(spark):
    x = fx.normalized(spark, SF)
    plan = plan_text(sample_vectors(x, top_variable(x, 150), ("sample_id", "hrs", "rep")))
    assert "pivotfirst" not in plan.lower()


def test_layout_splits_a_heavy_key(spark, tmp_path):
    t = (F.col("id") % 20 == 0).cast("int").alias("t")
    df = spark.range(200_000).select(t, F.xxhash64("id").alias("id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        write_table(df, str(tmp_path / "by_t"), "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.glob("by_t/t=0/*.parquet"))) > 4
    assert len(list(tmp_path.glob("by_t/t=1/*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "by_t")).count() == 200_000
    assert "REBALANCE" in plan_text(layout_by_key(df, "t", 7))
    assert rebalance(df, 6).rdd.getNumPartitions() == 6
    assert "REBALANCE" in plan_text(rebalance(df))


def test_persist_scope_releases(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError), persist_scope(df) as kept:
        assert kept.count() == 10 and kept.is_cached
        raise RuntimeError
    assert not df.is_cached


def test_checkpoint_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in sizing.shared_dir(spark)


def test_times_are_sorted(spark):
    x = long_counts(spark, [("a", "1A", t, 1) for t in (5, 0, 12, 5)])
    assert [r.hours for r in time_axis(x.repartition(3)).collect()] == [0, 5, 12]
