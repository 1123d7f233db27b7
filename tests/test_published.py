"""Sketches that merge, the largest of every group, tables that stay whole, headers of many files."""

import pytest
from pyspark.sql import functions as F

from helpers import leveled, plan_text, rows
from tallytide.operators import sketches as sk
from tallytide.operators import states
from tallytide.operators.ranking import top_changed_per, top_n_per, top_variable_per
from tallytide.sources import publish_table, read_count_matrix, read_published, replace_partitions
from tallytide.sources import readers
from tallytide.sources.published import superseded


def grouped(spark, n=30_000):
    """Entities in several classes and times each, a third of all rows in one class."""
    ids = spark.range(n)
    return ids.select(
        F.col("id").alias("gene_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("class"),
        F.explode(F.array(F.lit(0), (F.col("id") % 5).cast("int"))).alias("hours"),
    )


def test_rolled_up_sketches_stay_within_their_bounds(spark, tmp_path):
    data, path = grouped(spark), str(tmp_path / "sketches")
    for time in range(5):
        part = data.filter(F.col("hours") == time)
        states.append_state(sk.entity_sketches(part, ["class", "hours"]), path, f"t{time}")
    kept = states.read_states(spark, path)
    for keys in (["class"], ["hours"], ["class", "hours"], []):
        exact = {r[:-1]: r[-1] for r in rows(data.groupBy(*keys).agg(F.count_distinct("gene_id")))}
        found = {r[:-3]: r[-3:] for r in rows(sk.estimates(sk.roll_up(kept, keys)))}
        assert exact.keys() == found.keys()
        for key, (n, low, high) in found.items():
            assert low <= exact[key] <= high and low <= n <= high
            assert abs(n - exact[key]) <= sk.relative_error() * exact[key]
    # sums of classes and times count entities more than once, merged sketches do not
    assert sum(n for n, _, _ in found.values()) < 1.05 * 30_000


def test_sketches_of_odd_ids(spark):
    data = spark.createDataFrame([("a", None), ("a", 1.5), ("a", 1.5), ("b", None)], "k string, gene_id double")
    assert rows(sk.estimates(sk.entity_sketches(data, ["k"])), "k", "n_genes") == [("a", 1), ("b", 0)]
    assert sk.estimates(sk.entity_sketches(data.limit(0), ["k"])).count() == 0
    assert sk.estimates(sk.entity_sketches(data.limit(0), [])).first()["n_genes"] == 0


def test_top_per_group_with_ties_nulls_and_a_hot_group(spark):
    data = [("hot", i, float(i % 4)) for i in range(300)]
    data += [("b", 1, None), ("b", 2, 1.0), ("b", 3, 1.0), (None, 4, None), (None, 5, 2.0)]
    df = spark.createDataFrame(data, "g string, id int, v double").repartition(8)
    for parts in (1, 3, 64):
        found = rows(top_n_per(df, "g", "v", 2, "id", parts=parts).select("g", "rank", "id"))
        assert found == sorted(
            [("hot", 1, 3), ("hot", 2, 7), ("b", 1, 2), ("b", 2, 3), (None, 1, 5), (None, 2, 4)], key=repr
        )
    plan = plan_text(top_n_per(df, "g", "v", 2, "id"))
    tree = plan[: plan.index("(1)")] if "(1)" in plan else plan
    assert "WindowGroupLimit" in tree
    below = tree[tree.index("Exchange") :]
    assert "WindowGroupLimit" in below
    assert top_n_per(df.limit(0), "g", "v", 2, "id").count() == 0


def test_an_entity_of_two_processes_is_ranked_in_both(spark):
    x = leveled(spark, [(g, s, 0, v) for g, w in (("a", 1.0), ("b", 5.0), ("c", 2.0)) for s, v in (("s1", 0.0), ("s2", w))])
    listed = spark.createDataFrame(
        [("a", "p"), ("a", "p"), ("b", "p"), ("b", "q"), ("c", "q"), ("z", "q")], "gene_id string, immune_process string"
    )
    found = rows(top_variable_per(x, listed, n=1).select("immune_process", "gene_id", "rank"))
    assert found == [("p", "b", 1), ("q", "b", 1)]
    changes = spark.createDataFrame([("a", 1, -3.0), ("b", 1, 2.0), ("b", 2, 0.0)], "gene_id string, hours int, log2fc double")
    assert rows(top_changed_per(changes, n=1), "hours", "gene_id") == [(1, "a"), (2, "b")]


def test_a_run_that_dies_leaves_the_published_table_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no finished version"):
        read_published(spark, path)
    publish_table(spark.range(10), path)
    dying = spark.range(20).select(F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_table(dying, path)
    assert read_published(spark, path).count() == 10 and superseded(spark, path) == []
    publish_table(read_published(spark, path).filter("id > 4"), path)
    assert rows(read_published(spark, path)) == [(i,) for i in range(5, 10)]
    assert len(superseded(spark, path)) == 1


def test_replaced_partitions_leave_the_others(spark, tmp_path):
    path = str(tmp_path / "p")
    data = spark.range(12).select("id", (F.col("id") % 3).alias("hours"))
    replace_partitions(data, path, "hours")
    replace_partitions(data.filter("hours = 1 and id < 5"), path, "hours")
    replace_partitions(data.limit(0), path, "hours")
    kept = {r["id"] for r in spark.read.parquet(path).collect()}
    assert kept == {0, 1, 2, 3, 4, 5, 6, 8, 9, 11}
    dying = data.select("id", F.when(F.col("id") < 11, 0).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("hours"))
    with pytest.raises(Exception, match="lost"):
        replace_partitions(dying, path, "hours")
    assert spark.read.parquet(path).count() == 10


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_take_a_fixed_number_of_jobs(spark, tmp_path, monkeypatch):
    def folder(name, n):
        path = tmp_path / name
        path.mkdir()
        for i in range(n):
            order = ("1A", "1B") if i % 2 else ("1B", "1A")
            head = "\n" * (i % 3) + ",".join(["", *order])
            cells = {"1A": f"a{i}", "1B": f'"b,{i}"'}
            (path / f"part {i:03}.csv").write_text(f"{head}\ng{i},{cells[order[0]]},{cells[order[1]]}\n")
        (path / "empty.csv").write_text("")
        return str(path)

    few, many = folder("few", 12), folder("many", 150)
    a = jobs_of(spark, "few", lambda: readers._headers(spark, few))
    b = jobs_of(spark, "many", lambda: readers._headers(spark, many))
    assert b <= a + 2 < 20
    found = rows(read_count_matrix(spark, many).select("gene_id", "1A", "1B"))
    assert found == sorted((f"g{i}", f"a{i}", f"b,{i}") for i in range(150))
    small = rows(read_count_matrix(spark, few).select("gene_id", "1A", "1B"))
    # files beyond the size have their first line read one by one, with the same result
    monkeypatch.setattr(readers, "SMALL_FILE", 1)
    assert rows(read_count_matrix(spark, few).select("gene_id", "1A", "1B")) == small
