"""States of batches merge to one full run; PCA over all entities equals PCA over chosen ones."""

import pytest
from pyspark.sql import functions as F

from helpers import leveled, rows
from tallytide.operators import states
from tallytide.operators.aggregates import entity_variability
from tallytide.plans.projection import sample_pca
from tallytide.plans.wide import wide_pca


def close(a, b):
    return a == b or (a is not None and b is not None and a == pytest.approx(b, abs=1e-9))


def cells(spark):
    """Thirty entities in nine samples, some cells absent, one value null, one entity constant."""
    data = [
        (f"g{g:02}", f"s{s}", s, float((g * 7 + s * s * 5 + g * s) % 11)) for g in range(30)
        for s in range(9) if (g + s) % 4
    ]
    data += [("flat", f"s{s}", s, 3.0) for s in range(9)] + [("void", "s1", 1, None)]
    return leveled(spark, data)


def test_merged_moments_equal_one_run(spark, tmp_path):
    x, path = cells(spark), str(tmp_path / "moments")
    for i in range(3):
        states.append_state(states.moments(x.filter(F.col("hours") % 3 == i)), path, f"b{i}")
    # a repeated batch replaces itself
    states.append_state(states.moments(x.filter(F.col("hours") % 3 == 1)), path, "b1")
    found = rows(states.variability(states.merge_moments(states.read_states(spark, path))))
    whole = rows(entity_variability(x))
    assert len(found) == len(whole) == 32
    assert all(close(a, b) for f, w in zip(found, whole, strict=True) for a, b in zip(f, w, strict=True))


def test_moments_far_from_zero_keep_their_digits(spark, tmp_path):
    x, path = leveled(spark, [("a", f"s{s}", s, 1e9 + s) for s in range(6)]), str(tmp_path / "far")
    for i in range(6):
        states.append_state(states.moments(x.filter(F.col("hours") == i)), path, f"b{i}")
    merged = states.merge_moments(states.read_states(spark, path))
    assert states.variability(merged).first()["variance"] == pytest.approx(3.5)


@pytest.mark.parametrize("name", ["", "a/b", ".a", "_a"])
def test_names_that_spark_would_not_read_back(spark, tmp_path, name):
    with pytest.raises(ValueError, match="batch"):
        states.append_state(spark.range(1), str(tmp_path), name)


def test_wide_pca_equals_pca_over_all_entities_as_features(spark):
    x = cells(spark)
    keys = ("sample_id", "hours", "replicate")
    wide = wide_pca(x, 5, 2, keys)
    narrow = sample_pca(x, k=5, keys=keys, ids=x.select("gene_id").distinct())
    for a, b in ((wide.ratios, narrow.ratios), (wide.coordinates, narrow.coordinates)):
        a, b = rows(a), rows(b)
        assert len(a) == len(b)
        assert all(close(p, q) for f, w in zip(a, b, strict=True) for p, q in zip(f, w, strict=True))
    assert wide.loadings.count() == 32
    squares = wide.loadings.agg(F.sum(F.col("L1") ** 2), F.sum(F.col("L1") * F.col("L2"))).first()
    assert squares[0] == pytest.approx(1.0) and squares[1] == pytest.approx(0.0, abs=1e-9)


def test_wide_pca_of_nothing_one_sample_and_too_many(spark):
    x = cells(spark)
    assert wide_pca(x.limit(0)).coordinates.count() == 0
    one = wide_pca(x.filter("hours = 1"))
    assert [r.PC1 for r in one.coordinates.collect()] == [0.0]
    with pytest.raises(ValueError, match="9 samples"):
        wide_pca(x, max_samples=8)
