import numpy as np
import pytest
from helpers import leveled, rows
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallytide.operators.ml import (
    axis_signs,
    cluster_entities,
    fit_clusters,
    fit_pca,
    sample_coordinates,
    silhouette,
    standardize,
    standardize_vectors,
)
from tallytide.operators.ranking import time_axis, top_variable
from tallytide.operators.reshape import assemble, long_to_vector, pivot_samples
from tallytide.plans import (
    cluster_time_profiles,
    normalize,
    sample_pca,
    score_samples,
    sample_vectors,
    time_profiles,
)
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"
KEYS = ("sample_id", "hrs", "rep")


@pytest.fixture(scope="module")
def x(spark):
    return fx.normalized(spark, SF)


@pytest.fixture(scope="module")
def vectors(spark):
    return fx.vectors(spark, SF)


def arrays(df, key, vector):
    got = {r[0]: r[1] for r in df.select(key, vector_to_array(vector)).collect()}
    return np.array([got[k] for k in sorted(got)]), sorted(got)


def test_constant_feature_is_zero(spark):
    x = leveled(spark, [("k", f"{i}A", i, 0.1) for i in range(5)] + [("one", "0A", 0, 4.0)])
    assert {r.z for r in standardize(x).collect()} == {0.0}


def test_long_z_scores(x):
    z = standardize(x).groupBy("gene_id").agg(
        F.avg("z").alias("m"), F.stddev_samp("z").alias("s"), F.count("z").alias("n")
    )
    for r in z.filter("n > 1").collect():
        assert abs(r.m) < 1e-9 and r.s == pytest.approx(1.0)


def test_vector_and_long_z_scores_agree(spark, x):
    ids = top_variable(x, 40)
    wide = sample_vectors(x, ids, KEYS)
    scaled, _ = arrays(standardize_vectors(wide), "sample_id", "scaled_features")
    plain, _ = arrays(wide, "sample_id", "features")
    want = (plain - plain.mean(axis=0)) / plain.std(axis=0, ddof=1)
    assert np.allclose(scaled, want)


def test_vectors_equal_pivot_and_assemble(x):
    ids = [r[0] for r in top_variable(x, 60).orderBy("gene_id").collect()]
    wide = assemble(pivot_samples(x, ids, KEYS), [str(i) for i in ids])
    long = sample_vectors(x, top_variable(x, 60), KEYS)
    a, ka = arrays(wide, "sample_id", "features")
    b, kb = arrays(long, "sample_id", "features")
    assert ka == kb and np.array_equal(a, b)
    assert (b == 0).any()


def test_gaps_at_every_place(spark):
    index = spark.createDataFrame([(f, i) for i, f in enumerate("abcde")], "f string, __idx int")
    cells = [("none", "zz", 1.0), ("mid", "c", 3.0), ("ends", "a", 1.0), ("ends", "e", 5.0),
             ("null", "b", None), ("two", "d", 4.0), ("two", "d", 9.0)]
    df = spark.createDataFrame(cells, "k string, f string, v double")
    out = long_to_vector(df, ["k"], "f", "v", index, 5)
    got = {r[0]: list(r[1]) for r in out.select("k", vector_to_array("features")).collect()}
    assert got == {
        "mid": [0, 0, 3, 0, 0], "ends": [1, 0, 0, 0, 5], "null": [0, 0, 0, 0, 0],
        "two": [0, 0, 0, 9, 0],
    }


def test_pca_invariants(vectors):
    model, ratios = fit_pca(vectors, k=5)
    data, _ = arrays(vectors, "vec_id", "features")
    cov = np.cov(data.T)
    axes = model.pc.toArray()
    share = [r.ratio for r in ratios.orderBy("component").collect()]
    assert np.allclose(axes.T @ axes, np.eye(5))
    assert np.allclose(cov @ axes, axes * (np.array(share) * np.trace(cov)))
    assert share == sorted(share, reverse=True) and 0 < sum(share) <= 1
    signed = axes * axis_signs(model)
    assert (signed[np.abs(signed).argmax(axis=0), range(5)] > 0).all()
    coords, _ = np.array(sorted(rows(sample_coordinates(model, vectors, 5, ["vec_id"])))), None
    assert np.allclose(coords[:, 1:], data @ signed)


def test_samples_are_placed_in_a_fitted_space(x):
    result = sample_pca(x, 50, 3, 2, KEYS)
    some = [r["sample_id"] for r in x.select("sample_id").distinct().orderBy("sample_id").limit(3).collect()]
    part = x.filter(F.col("sample_id").isin(some))
    want = [r for r in rows(result.coordinates) if r[0] in some]
    for a, b in zip(want, rows(score_samples(result, part, 2, KEYS)), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])


def test_pca_ignores_the_input_split(x):
    want = sample_pca(x, 50, 3, 2, KEYS).coordinates
    again = sample_pca(x.repartition(13), 50, 3, 2, KEYS).coordinates
    for a, b in zip(rows(want), rows(again), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])


def test_standardised_variance_is_the_ratio_times_features(x):
    result = sample_pca(x, 50, 3, 2, KEYS)
    ratios = [r.ratio for r in result.ratios.orderBy("component").collect()]
    spread = result.coordinates.agg(F.var_samp("PC1"), F.var_samp("PC2"), F.avg("PC1")).first()
    assert spread[0] / 50 == pytest.approx(ratios[0])
    assert spread[1] / 50 == pytest.approx(ratios[1])
    assert abs(spread[2]) < 1e-9


def test_clusters_are_valid_and_stable(vectors):
    labels = [
        rows(cluster_entities(v, "vec_id", k=5), "vec_id", "cluster")
        for v in (vectors, vectors.repartition(7), vectors.coalesce(1))
    ]
    assert labels[0] == labels[1] == labels[2]
    assert len(labels[0]) == vectors.count()
    assert {c for _, c in labels[0]} == set(range(5))


def test_rounds_end_where_centres_are_the_means_of_their_rows(spark):
    point = F.array(*[F.rand(s) * 10 for s in (1, 2, 3)])
    data = spark.range(0, 600, 1, 4).select(F.col("id").alias("gene_id"), array_to_vector(point).alias("features"))
    found = fit_clusters(data.checkpoint(), k=4, rounds=200)
    assert found.settled and all(a >= b - 1e-9 for a, b in zip(found.cost, found.cost[1:], strict=False))
    values, _ = arrays(found.rows, "gene_id", "features")
    labels = np.array([r.cluster for r in found.rows.orderBy("gene_id").collect()])
    for r in found.centres.collect():
        assert np.allclose(values[labels == r.cluster].mean(axis=0), r.centre)
    gaps = ((values[:, None, :] - np.array([r.centre for r in found.centres.orderBy("cluster").collect()])) ** 2).sum(axis=2)
    assert (gaps.argmin(axis=1) == labels).all()
    assert found.cost[-1] == pytest.approx(gaps.min(axis=1).sum())


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(i, [float(i % 2)]) for i in range(6)], "gene_id long, a array<double>")
    df = df.select("gene_id", array_to_vector("a").alias("features"))
    found = fit_clusters(df, k=4)
    assert sorted(r.cluster for r in found.rows.collect()) == [0, 0, 0, 1, 1, 1]
    assert fit_clusters(df.limit(0), k=4).rows.count() == 0


def test_labels_do_not_depend_on_the_layout(vectors):
    labels = [
        rows(cluster_entities(vectors.repartition(n), "vec_id", k=5), "vec_id", "cluster") for n in (1, 16, 200)
    ]
    assert labels[0] == labels[1] == labels[2]


def test_each_row_is_nearest_its_own_center(x):
    out = cluster_time_profiles(x, 100, 4, t="hrs")
    profiles = time_profiles(x, time_axis(x, "hrs"), t="hrs")
    data, keys = arrays(profiles, "gene_id", "features")
    label = {r[0]: r[1] for r in out.labels.collect()}
    chosen = np.array([k in label for k in keys])
    data = data[chosen]
    own = np.array([label[k] for k in keys if k in label])
    centers = np.array([data[own == c].mean(axis=0) for c in range(4)])
    distance = ((data[:, None, :] - centers[None]) ** 2).sum(axis=2)
    # Lloyd's steps may stop short of a fixed point, so a few rows may sit on a border.
    assert (distance.argmin(axis=1) == own).mean() > 0.9
    sizes = {r.cluster: r.n_entities for r in out.profiles.select("cluster", "n_entities").distinct().collect()}
    assert sum(sizes.values()) == 100 == len(label)
    assert -1 <= out.silhouette.first()[0] <= 1


def test_separate_groups_are_found(spark):
    points = [(i, [float(i % 3) * 100 + (i % 7) * 0.1, 0.0]) for i in range(60)]
    df = spark.createDataFrame(points, "gene_id long, a array<double>").select(
        "gene_id", array_to_vector("a").alias("features")
    )
    found = cluster_entities(df, k=3)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.cluster, set()).add(r.gene_id % 3)
    assert sorted(map(len, groups.values())) == [1, 1, 1]
    assert silhouette(found).first()[0] > 0.99


def test_centering_removes_level(spark):
    x = leveled(spark, [("lo", "1A", 0, 1.0), ("lo", "2A", 5, 3.0), ("hi", "1A", 0, 11.0), ("hi", "2A", 5, 13.0)])
    out = time_profiles(x, time_axis(x), center=True)
    data, _ = arrays(out, "gene_id", "features")
    assert np.allclose(data, [[-1, 1], [-1, 1]])


def test_full_run_on_text_ids(spark):
    counts = fx.counts(spark, SF).select(
        F.concat(F.lit("g"), F.col("gene_id").cast("string")).alias("gene_id"),
        "sample_id", F.col("hrs").alias("hours"), F.col("hrs").alias("time_point"),
        F.col("rep").alias("replicate"), F.col("n").alias("raw_count"),
    )
    x = normalize(counts, 500)
    assert sample_pca(x, 30).coordinates.count() == 14
    assert cluster_time_profiles(x, 30).labels.count() == 30
