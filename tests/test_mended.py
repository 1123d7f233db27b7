"""Cases that once went wrong: column order, ragged rows, nulls, collations, copies of one row."""

import math
import time

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from helpers import rows
from tallytide import functions as fn
from tallytide.operators import sizing
from tallytide.operators.ml import cluster_entities, fit_clusters, misplaced, standardize
from tallytide.sources import read_annotation, read_count_matrix, read_sample_metadata
from workload.queries import QUERIES


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_matrix_files_are_read_by_name(spark, tmp_path):
    path = put(tmp_path / "m", p1=",1A,1B\ng1,1,2\n", p2=",1B,1A\ng3,20,10\n")
    assert rows(read_count_matrix(spark, path), "gene_id", "1A", "1B") == [
        ("g1", "1", "2"),
        ("g3", "10", "20"),
    ]


def test_matrix_files_must_have_the_same_samples(spark, tmp_path):
    path = put(tmp_path / "m", p1=",1A,1B\ng1,1,2\n", p2=",1A,1C\ng3,20,10\n")
    with pytest.raises(ValueError, match="not all files have"):
        read_count_matrix(spark, path)


def test_side_files_are_read_by_name(spark, tmp_path):
    head = "sample,replicate,time,hours,time_label,sample_ID"
    turned = "sample_ID,hours,sample,time_label,time,replicate"
    path = put(tmp_path / "s", a=f"{head}\nx,A,1,0,0 h,1A\n", b=f"{turned}\n2A,6,y,6 h,2,A\n")
    found = rows(read_sample_metadata(spark, path), "sample_id", "full_sample_name", "hours")
    assert found == [("1A", "x", 0), ("2A", "y", 6)]
    one, two = "Symbol,FlyBaseID,Functional Class,Immune Process", "FlyBaseID,Symbol,Immune Process,Functional Class"
    path = put(tmp_path / "g", a=f"{one}\ns1,f1,c1,p1\n", b=f"{two}\nf2,s2,p2,c2\n")
    assert rows(read_annotation(spark, path), "gene_id", "Symbol", "functional_class") == [
        ("f1", "s1", "c1"),
        ("f2", "s2", "c2"),
    ]


@pytest.mark.parametrize("line", ["g1,1,2,99", "g1,1"])
def test_ragged_rows_fail_with_the_file(spark, tmp_path, line):
    path = put(tmp_path / "r", only=f",1A,1B\n{line}\n")
    with pytest.raises(Exception, match="only.csv"):
        read_count_matrix(spark, path).select("gene_id").collect()


@pytest.mark.parametrize("limit", [sizing.BROADCAST_LIMIT_BYTES, -1])
def test_null_values_have_no_score(spark, limit, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_LIMIT_BYTES", limit)
    cells = [("k", 5.0), ("k", 5.0), ("k", None), ("j", 1.0), ("j", 3.0), ("j", None)]
    df = spark.createDataFrame(cells, "gene_id string, log2_cpm double")
    z = {(r.gene_id, r.log2_cpm): r.z for r in standardize(df).collect()}
    assert z[("k", 5.0)] == 0.0 and z[("k", None)] is None and z[("j", None)] is None
    assert z[("j", 3.0)] == pytest.approx(math.sqrt(0.5))


@pytest.mark.parametrize("limit", [sizing.BROADCAST_LIMIT_BYTES, -1])
def test_collated_keys_join_as_spark_joins_them(spark, limit):
    kind = "k string COLLATE UTF8_LCASE"
    fact = spark.createDataFrame([("A", i) for i in range(5)] + [("a", i) for i in range(5)], f"{kind}, n int")
    side = spark.createDataFrame([("a", 1)], f"{kind}, v int")
    plain = fact.join(side, "k").count()
    assert sizing.lookup_join(fact, side, "k", limit_bytes=limit).count() == plain == 10


@pytest.mark.parametrize("limit", [sizing.BROADCAST_LIMIT_BYTES, -1])
def test_a_column_on_both_sides_is_an_error(spark, limit):
    fact = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError, match="both sides"):
        sizing.lookup_join(fact, fact, "k", limit_bytes=limit)
    assert sizing.lookup_join(fact, fact, "k", "left_semi", limit_bytes=limit).count() == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_copies_of_one_row_spread_over_tasks(spark, how):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        fact = spark.range(0, 30000, 1, 8).select(key.alias("k"))
        side = spark.createDataFrame([(7,), (11,)], "k bigint")
        out = sizing.split_join(fact, side, "k", how)
        expected = fact.join(side, "k", how)
        assert out.groupBy("k").count().orderBy("k").collect() == (
            expected.groupBy("k").count().orderBy("k").collect()
        )
        if how != "left_anti":
            hot = out.filter("k = 7").select(F.spark_partition_id().alias("p")).distinct()
            assert hot.count() >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_more_row_leaves_the_clusters(spark):
    point = F.array(F.rand(1) * 10, F.rand(2) * 10)
    data = spark.range(0, 3001, 1, 4).select(F.col("id").alias("gene_id"), array_to_vector(point).alias("features"))
    data = data.checkpoint()
    labels = [
        {r.gene_id: r.cluster for r in cluster_entities(data.filter(F.col("gene_id") < n)).collect()}
        for n in (3000, 3001)
    ]
    same = sum(labels[1][k] == v for k, v in labels[0].items())
    assert same > 2900


def test_clusters_are_numbered_by_their_smallest_key(spark):
    points = [(i, [float(i * 7 % 4) * 100]) for i in range(40)]
    df = spark.createDataFrame(points, "gene_id long, a array<double>").select(
        "gene_id", array_to_vector("a").alias("features")
    )
    found = fit_clusters(df, k=4)
    least = found.rows.groupBy("cluster").agg(F.min("gene_id").alias("least")).orderBy("cluster")
    assert [tuple(r) for r in least.collect()] == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert sorted(r.centre[0] for r in found.centres.collect()) == [0.0, 100.0, 200.0, 300.0]
    assert tuple(misplaced(found).first()) == (40, 4, 0)


def test_parts_without_a_flag_have_an_empty_slot(spark, tmp_path):
    lines = [(1, "A", 2.0), (1, "A", 3.0), (1, "N", 4.0), (1, "R", 5.0), (2, "N", 6.0), (2, None, 7.0)]
    lines += [(None, "R", None)]
    made = spark.createDataFrame(lines, "l_partkey long, l_returnflag string, l_quantity double")
    made.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["assemble"](spark, str(tmp_path))
    assert found.dtypes == [("gene_id", "bigint"), ("slot", "int"), ("value", "double")]
    assert rows(found) == sorted(
        [(1, 0, 5.0), (1, 1, 4.0), (1, 2, 5.0), (2, 0, None), (2, 1, 6.0), (2, 2, None)]
        + [(None, 0, None), (None, 1, None), (None, 2, None)],
        key=repr,
    )


def test_text_that_is_no_number_costs_little_more_than_numbers(spark):
    texts = ["1e3", "12.9", " 12 ", "\t12.5\n", "+1", "-.5", "5.", ".", "e5", "1e", "٣", "٣.٥", "1d", "NaN"]
    texts += ["1" * 39, "9" * 30, "1e400", "1e-400", "3000000000", "\xa012", "12\x00", "\x7f12", "", " ", None]
    odd = spark.createDataFrame([(t,) for t in texts], "v string")
    for cast, kind in ((fn.to_int, "int"), (fn.to_count, "bigint")):
        direct = F.col("v").try_cast(kind)
        detour = F.col("v").try_cast("decimal(38,18)").try_cast(kind)
        assert all(a == b for a, b in odd.select(cast("v"), F.coalesce(direct, detour)).collect())
    other = spark.sql("SELECT true AS t, 12.9D AS d, float('nan') AS f, 7L AS n")
    assert other.select(*(fn.to_int(c) for c in "tdfn")).first() == (1, 12, None, 7)

    def seconds(column):
        began = time.perf_counter()
        cells.select(fn.to_count(column)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    cells = spark.range(0, 400_000, 1, 2).selectExpr("string(id) AS good", "concat('no ', id) AS bad").cache()
    cells.count()
    assert min(seconds("bad") for _ in range(3)) < 4 * min(seconds("good") for _ in range(3)) + 0.5
