import pytest
from helpers import leveled, rows
from pyspark.sql import functions as F

from tallytide.operators.aggregates import (
    cluster_profiles,
    entity_variability,
    first_value,
    mean_by_time,
    process_trajectory,
    profile,
)
from tallytide.operators.joins import attach_baseline, restrict_to
from tallytide.operators.quality import require_unique, without_baseline
from tallytide.operators.ranking import top_n, top_variable
from tallytide.operators.reshape import fill_missing, melt_matrix, pivot_values
from tallytide.operators.sets import difference, replicate_rows
from tallytide.plans import (
    changed_entities,
    dynamics,
    fold_change,
    fold_change_for,
    heat_matrix,
)


def test_single_sample_has_null_variance_and_sorts_last(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "2A", 1, 3.0), ("b", "1A", 0, 9.0)])
    assert rows(entity_variability(x)) == [("a", 2.0, 2.0, 2), ("b", None, 9.0, 1)]
    assert [r.gene_id for r in top_variable(x, 2).collect()] == ["a", "b"]


def test_null_levels_count_as_samples(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "2A", 1, None), ("a", "3A", 2, 3.0)])
    assert rows(entity_variability(x)) == [("a", 2.0, 2.0, 3)]


def test_ties_break_on_id(spark):
    df = spark.createDataFrame([("b", 1.0), ("c", 1.0), ("a", 1.0), ("z", 2.0)], "gene_id string, v double")
    assert [r.gene_id for r in top_n(df.repartition(5), "v", 3, "gene_id").collect()] == ["z", "a", "b"]


CHANGE = [
    ("up", "1A", 0, 1.0), ("up", "1B", 0, 3.0), ("up", "2A", 4, 4.0), ("up", "3A", 8, 5.5),
    ("edge", "1A", 0, 2.0), ("edge", "2A", 4, 1.0), ("edge", "3A", 8, 3.0),
    ("late", "2A", 4, 7.0),
    ("only", "1A", 0, 7.0),
    ("blank", "1A", 0, None), ("blank", "2A", 4, 7.0),
]


def test_fold_change(spark):
    fc = fold_change(leveled(spark, CHANGE))
    assert fc.columns == ["gene_id", "hours", "time_point", "mean_log2_cpm", "ctrl_expr", "log2fc"]
    assert rows(fc, "gene_id", "hours", "ctrl_expr", "log2fc") == [
        ("blank", 4, None, None),
        ("edge", 4, 2.0, -1.0), ("edge", 8, 2.0, 1.0),
        ("up", 4, 2.0, 2.0), ("up", 8, 2.0, 3.5),
    ]
    means = mean_by_time(leveled(spark, CHANGE))
    assert tuple(without_baseline(means).first()) == (5, 1)


def test_fold_change_equals_a_self_join(spark):
    means = mean_by_time(leveled(spark, CHANGE))
    base = means.filter("hours = 0").select("gene_id", F.col("mean_log2_cpm").alias("ctrl_expr"))
    joined = means.filter("hours > 0").join(base, "gene_id")
    columns = ["gene_id", "hours", "mean_log2_cpm", "ctrl_expr"]
    assert rows(attach_baseline(means), *columns) == rows(joined, *columns)


def test_other_baseline(spark):
    fc = fold_change(leveled(spark, CHANGE), baseline=4)
    assert rows(fc, "gene_id", "hours", "log2fc") == [("edge", 8, 2.0), ("up", 8, 1.5)]


def test_threshold_is_strict(spark):
    fc = fold_change(leveled(spark, CHANGE))
    assert rows(changed_entities(fc)) == [("up", 3.5)]
    assert rows(changed_entities(fc, 0.5)) == [("edge", 1.0), ("up", 3.5)]


def test_fold_change_for_listed(spark):
    x = leveled(spark, CHANGE)
    ids = spark.createDataFrame([("edge",), ("edge",), ("late",)], "gene_id string")
    got = fold_change_for(x, ids).select("gene_id", "hours").collect()
    assert [tuple(r) for r in got] == [("edge", 4), ("edge", 8)]


def test_heat_matrix(spark):
    fc = fold_change(leveled(spark, [*CHANGE, ("gap", "1A", 0, 0.0), ("gap", "3A", 8, 9.0)]))
    heat = heat_matrix(fc, 2)
    assert heat.columns == ["gene_id", "4", "8"]
    assert rows(heat) == [("gap", None, 9.0), ("up", 2.0, 3.5)]


def test_annotation_fans_out_and_classes_weigh_the_same(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("b", "1A", 0, 2.0), ("c", "1A", 0, 6.0), ("d", "1A", 0, 50.0)])
    ann = spark.createDataFrame(
        [("a", "p", "k1"), ("b", "p", "k1"), ("c", "p", "k2"), ("c", "q", "k2")],
        "gene_id string, immune_process string, functional_class string",
    )
    dyn = dynamics(x, ann)
    assert [tuple(r) for r in dyn.collect()] == [
        ("p", "k1", 0, 1.5, 2), ("p", "k2", 0, 6.0, 1), ("q", "k2", 0, 6.0, 1),
    ]
    assert rows(process_trajectory(dyn)) == [("p", 0, 3.75), ("q", 0, 6.0)]
    assert rows(process_trajectory(dyn, weighted=True)) == [("p", 0, 3.0), ("q", 0, 6.0)]


def test_cluster_profiles(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "1B", 0, 3.0), ("b", "1A", 0, 6.0), ("c", "1A", 0, 9.0), ("a", "2A", 5, 4.0)])
    labels = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "gene_id string, cluster int")
    assert rows(cluster_profiles(x, labels)) == [(0, 0, 4.0, 2), (0, 5, 4.0, 2), (1, 0, 9.0, 1)]


def test_restrict_ignores_duplicate_ids(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("b", "1A", 0, 2.0)])
    ids = spark.createDataFrame([("a",), ("a",), ("q",)], "gene_id string")
    assert rows(restrict_to(x, ids), "gene_id") == [("a",)]


def test_melt_undoes_pivot(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "2.A", 1, 2.0), ("b", "1A", 0, 3.0)])
    wide = pivot_values(x, ["gene_id"], "sample_id", ["1A", "2.A"], "log2_cpm")
    assert rows(melt_matrix(wide, count="v").filter("v is not null")) == [
        ("a", "1A", 1.0), ("a", "2.A", 2.0), ("b", "1A", 3.0),
    ]
    filled = pivot_values(x, ["gene_id"], "sample_id", ["1A", "2.A"], "log2_cpm", fill=0.0)
    assert rows(filled) == [("a", 1.0, 2.0), ("b", 3.0, 0.0)] == rows(fill_missing(wide))


def test_small_table_operators(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "2A", 1, 2.0), ("b", "1A", 0, 3.0)])
    assert tuple(profile(x).first()) == (3, 2, 2)
    assert tuple(profile(x, approximate=True).first()) == (3, 2, 2)
    assert rows(first_value(x, ["gene_id", "sample_id"], "log2_cpm")) == [
        ("a", "1A", 1.0), ("a", "2A", 2.0), ("b", "1A", 3.0),
    ]
    ones = spark.createDataFrame([(1,), (1,), (1,), (2,)], "v int")
    assert rows(difference(ones, spark.createDataFrame([(1,), (3,)], "v int"))) == [(1,), (1,), (2,)]
    assert rows(replicate_rows(ones.distinct(), 2)) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_duplicate_key_error(spark):
    x = leveled(spark, [("a", "1A", 0, 1.0), ("a", "1A", 0, 2.0)])
    with pytest.raises(ValueError, match="counts: duplicate keys.*'a', '1A'"):
        require_unique(x, ["gene_id", "sample_id"], "counts")
    require_unique(x.dropDuplicates(["gene_id"]), ["gene_id", "sample_id"], "counts")


def test_absent_cells_count_as_zeros_and_null_values_do_not(spark):
    x = leveled(spark, [("a", "1A", 0, 4.0), ("a", "2A", 5, None), ("b", "1A", 0, 2.0), ("b", "3A", 5, 6.0)])
    spread = {r.gene_id: (r.n_samples, r.mean_expr, r.variance) for r in entity_variability(x, absent="zero").collect()}
    assert spread["a"] == (2, 2.0, 8.0)
    assert spread["b"][:2] == (3, pytest.approx(8 / 3)) and spread["b"][2] == pytest.approx(28 / 3)
    means = {(r.gene_id, r.hours): r.mean_log2_cpm for r in mean_by_time(x, absent="zero").collect()}
    assert means == {("a", 0): 4.0, ("a", 5): 0.0, ("b", 0): 2.0, ("b", 5): 3.0}
    more = leveled(spark, [("-", s, t, 0.0) for s, t in (("1A", 0), ("4A", 0), ("2A", 5), ("3A", 5), ("5A", 9))])
    means = {(r.gene_id, r.hours): r.mean_log2_cpm for r in mean_by_time(x, absent="zero", samples=more).collect()}
    assert means[("a", 0)] == 2.0 and means[("b", 9)] == 0.0 and len(means) == 6
    assert mean_by_time(x.limit(0), absent="zero").count() == 0
    with pytest.raises(ValueError, match="absent"):
        entity_variability(x, absent="maybe")
