"""One query per operator, over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide import functions as fn
from tallytide import plans
from tallytide.operators import aggregates as ag
from tallytide.operators import joins as jn
from tallytide.operators import layout as ly
from tallytide.operators import ml
from tallytide.operators import quality as qc
from tallytide.operators import ranking as rk
from tallytide.operators import reshape as rs
from tallytide.operators import sets as st
from tallytide.operators import sketches as sk
from tallytide.operators import states as sa
from tallytide.sources import (
    read_annotation,
    read_count_matrix,
    read_sample_metadata,
    read_table,
    write_result,
    write_table,
)
from tallytide.sources.published import (
    partition_rows,
    publish_table,
    read_published,
    replace_partitions,
    superseded,
)
from tallytide.sources.buckets import read_bucketed, write_bucketed
from tallytide.plans.wide import wide_pca as pca_over_all
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ("sample_id", "hrs", "rep")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines; adding zero turns -0.0 into 0.0."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits) + F.lit(0.0)


def tidy(df: DataFrame, *doubles: str) -> DataFrame:
    return df.withColumns({c: rounded(c) for c in doubles})


def exploded(df: DataFrame, keys: list[str], vector: str = "features") -> DataFrame:
    """A vector column as rows of (key, slot, value)."""
    return df.select(*keys, F.posexplode(vector_to_array(vector)).alias("slot", "value"))


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return plans.fold_change(fx.normalized(spark, sf), t="hrs", also=())


# ---- sources and sinks -------------------------------------------------------------------------


def metadata_csv(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        named = fx.sample_table(spark, sf).select(
            F.concat(F.lit("lib "), "sample_id").alias("sample"),
            F.col("rep").alias("replicate"),
            (F.col("hrs") + 1).alias("time"),
            F.col("hrs").alias("hours"),
            F.concat(F.col("hrs").cast("string"), F.lit(" h")).alias("time_label"),
            F.col("sample_id").alias("sample_ID"),
        )
        write_result(named, path)

    return fx.stage_path(spark, sf, "metadata_csv", write)


def matrix_csv(spark: SparkSession, sf: str) -> str:
    """The counts as a wide CSV with one column per sample and blank cells for gaps."""

    def write(path: str) -> None:
        counts = fx.counts(spark, sf)
        names = rk.ordered(st.distinct_values(counts, ["sample_id"]), ["sample_id"]).collect()
        wide = rs.pivot_values(counts, ["gene_id"], "sample_id", [r[0] for r in names], "n")
        write_result(wide.withColumnRenamed("gene_id", ""), path)

    return fx.stage_path(spark, sf, "matrix_csv", write)


@query
def sample_metadata_csv(spark, sf):
    return read_sample_metadata(spark, metadata_csv(spark, sf))


@query
def count_matrix_csv(spark, sf):
    path = fx.scratch_path(spark, "wide")
    write_result(fx.wide(spark, sf).withColumnRenamed("gene_id", ""), path)
    return read_count_matrix(spark, path)


@query
def table_scan(spark, sf):
    return read_table(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    )


@query
def table_round_trip(spark, sf):
    path = fx.scratch_path(spark, "by_time")
    write_table(fx.counts(spark, sf), path, partition_by="hrs")
    return read_table(spark, path, ["gene_id", "sample_id", "hrs", "rep", "n"])


@query
def result_round_trip(spark, sf):
    path = fx.scratch_path(spark, "totals")
    write_result(ag.entity_totals(fx.counts(spark, sf), count="n"), path)
    return spark.read.schema("gene_id bigint, total_count bigint").csv(path, header=True)


@query
def annotation_csv(spark, sf):
    path = fx.scratch_path(spark, "annotation")
    write_result(
        fx.annotation(spark, sf).select(
            F.concat(F.lit("sym"), F.col("gene_id").cast("string")).alias("Symbol"),
            F.col("gene_id").alias("FlyBaseID"),
            F.col("class").alias("Functional Class"),
            F.col("process").alias("Immune Process"),
        ),
        path,
    )
    return read_annotation(spark, path)


@query
def result_as_lookup(spark, sf):
    x = fx.normalized(spark, sf)
    path = fx.scratch_path(spark, "top")
    write_result(rk.top_variable(x, 100, value="log2_cpm"), path, "parquet")
    ids = read_table(spark, path, ["gene_id"])
    return jn.restrict_to(x, ids).select("gene_id", "sample_id", "n")


# ---- projection and filter ---------------------------------------------------------------------


@query
def known_samples(spark, sf):
    flags = (
        fx.table(spark, sf, "lineitem")
        .select(F.col("l_returnflag").alias("sample_id"))
        .distinct()
        .filter(F.col("sample_id") != "N")
    )
    return rs.select_known_samples(fx.wide(spark, sf), flags)


def text_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Line quantities as text with blank, malformed and decimal cells among them."""
    cell = (
        F.when(F.col("l_discount") == 0, F.lit(None))
        .when(F.col("l_tax") == 0, F.lit("x"))
        .when(F.col("l_linenumber") == 1, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".9")))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cell.alias("raw_count")
    )


@query
def clean_counts(spark, sf):
    return rs.clean_counts(text_counts(spark, sf))


@query
def cell_report(spark, sf):
    return qc.cell_report(text_counts(spark, sf))


@query
def project_rename(spark, sf):
    return rs.project(
        fx.table(spark, sf, "lineitem"),
        {"l_partkey": "gene_id", "l_linestatus": "replicate", "l_quantity": "raw_count"},
    )


@query
def scalar_predicates(spark, sf):
    return fx.counts(spark, sf).filter((F.col("n") >= 50) & (F.col("hrs") > 0) & (F.col("rep") == "F"))


@query
def restrict_to(spark, sf):
    x = fx.normalized(spark, sf)
    return jn.restrict_to(x, rk.top_variable(x, 100)).select("gene_id", "sample_id", "n")


def time_table(spark: SparkSession, sf: str) -> DataFrame:
    """Counts with one column for every time that occurs, gaps null."""
    c = fx.counts(spark, sf)
    times = [r[0] for r in rk.time_axis(c, "hrs").collect()]
    return rs.pivot_values(c, ["gene_id"], "hrs", times, "n", F.sum)


@query
def fill_missing(spark, sf):
    filled = rs.fill_missing(time_table(spark, sf), 0)
    return filled.unpivot(["gene_id"], [c for c in filled.columns if c != "gene_id"], "hrs", "n")


# ---- reshape -----------------------------------------------------------------------------------


@query
def melt_matrix(spark, sf):
    return rs.melt_matrix(fx.wide(spark, sf))


@query
def melt_with_gaps(spark, sf):
    return rs.melt_matrix(time_table(spark, sf), sample="hrs", count="n")


@query
def pivot_samples(spark, sf):
    """The sample by entity matrix of the 100 most variable entities, melted back to rows."""
    x = fx.normalized(spark, sf)
    top = jn.settled_ids(rk.top_variable(x, 100), "gene_id")
    ids = [r[0] for r in rk.ordered(top.table, ["gene_id"]).collect()]
    matrix = rs.pivot_samples(jn.restrict_to(x, top), ids, KEYS)
    long = matrix.unpivot(list(KEYS), [str(i) for i in ids], "gene_id", "value")
    return tidy(long, "value")


@query
def pivot_time(spark, sf):
    x = fx.normalized(spark, sf)
    times = [r[0] for r in rk.time_axis(x, "hrs").collect()]
    out = rs.pivot_time(ag.mean_by_time(x, t="hrs"), times, t="hrs")
    return tidy(out.unpivot(["gene_id"], [str(t) for t in times], "hrs", "level"), "level")


@query
def heat_matrix(spark, sf):
    out = plans.heat_matrix(changes(spark, sf), 50, t="hrs")
    times = [c for c in out.columns if c != "gene_id"]
    return tidy(out.unpivot(["gene_id"], times, "hrs", "log2fc"), "log2fc")


@query
def assemble(spark, sf):
    wide = fx.wide(spark, sf)
    # lines without a flag have a column of their own, but no slot
    flags = [c for c in wide.columns if c not in ("gene_id", "null")]
    slots = exploded(rs.assemble(wide, flags, nulls="keep"), ["gene_id"])
    # sums are whole numbers, so NaN only stands for a part without lines of that flag
    return slots.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@query
def long_to_vector(spark, sf):
    x = fx.normalized(spark, sf)
    out = exploded(plans.sample_vectors(x, rk.top_variable(x, 100), KEYS), list(KEYS))
    return tidy(out, "value")


@query
def vector_columns(spark, sf):
    out = rs.vector_columns(fx.vectors(spark, sf), "features", ["PC1", "PC2"])
    return tidy(out, "PC1", "PC2")


# ---- joins -------------------------------------------------------------------------------------


@query
def attach_metadata(spark, sf):
    c = fx.counts(spark, sf)
    return jn.attach_metadata(
        c.select("sample_id", "gene_id", "n"), fx.sample_table(spark, sf).filter(F.col("hrs") < 6)
    )


@query
def filter_low_count(spark, sf):
    return jn.filter_low_count(fx.counts(spark, sf), fx.MIN_TOTAL, count="n")


@query
def attach_library_size(spark, sf):
    return jn.attach_library_size(fx.counts(spark, sf), count="n")


@query
def attach_baseline(spark, sf):
    means = ag.mean_by_time(fx.normalized(spark, sf), t="hrs")
    return tidy(jn.attach_baseline(means, t="hrs"), "mean_log2_cpm", "ctrl_expr")


@query
def without_baseline(spark, sf):
    return qc.without_baseline(ag.mean_by_time(fx.normalized(spark, sf), t="hrs"), t="hrs")


@query
def annotate(spark, sf):
    x = fx.normalized(spark, sf).select("gene_id", "sample_id", "n")
    return jn.annotate(x, fx.annotation(spark, sf))


@query
def attach_labels(spark, sf):
    x = fx.normalized(spark, sf).select("gene_id", "sample_id", "n")
    return jn.attach_labels(x, fx.fixed_labels(spark, sf))


@query
def missing_samples(spark, sf):
    meta = fx.table(spark, sf, "part").select(F.col("p_brand").alias("sample_id"))
    seen = (
        fx.table(spark, sf, "part").filter(F.col("p_size") > 49).select(F.col("p_brand").alias("sample_id"))
    )
    return jn.missing_samples(meta, seen)


# ---- aggregates --------------------------------------------------------------------------------


@query
def entity_totals(spark, sf):
    return ag.entity_totals(fx.counts(spark, sf), count="n")


@query
def library_sizes(spark, sf):
    return ag.library_sizes(fx.counts(spark, sf), count="n")


@query
def entity_variability(spark, sf):
    return tidy(ag.entity_variability(fx.normalized(spark, sf)), "variance", "mean_expr")


@query
def mean_by_time(spark, sf):
    return tidy(ag.mean_by_time(fx.normalized(spark, sf), t="hrs"), "mean_log2_cpm")


@query
def max_abs_change(spark, sf):
    return tidy(ag.max_abs_change(changes(spark, sf)), "max_abs_log2fc")


@query
def annotation_dynamics(spark, sf):
    annotated = jn.annotate(fx.normalized(spark, sf), fx.annotation(spark, sf))
    return tidy(ag.annotation_dynamics(annotated, "process", "class", "hrs"), "mean_log2_cpm")


def _dynamics(spark: SparkSession, sf: str, in_order: bool = True) -> DataFrame:
    x, groups = fx.normalized(spark, sf), fx.annotation(spark, sf)
    return plans.dynamics(x, groups, "process", "class", "hrs", in_order=in_order)


@query
def process_trajectory(spark, sf):
    return tidy(ag.process_trajectory(_dynamics(spark, sf, False), "process", "hrs"), "mean_log2_cpm")


@query
def process_trajectory_weighted(spark, sf):
    out = ag.process_trajectory(_dynamics(spark, sf, False), "process", "hrs", weighted=True)
    return tidy(out, "mean_log2_cpm")


@query
def cluster_profiles(spark, sf):
    out = ag.cluster_profiles(fx.normalized(spark, sf), fx.fixed_labels(spark, sf), t="hrs")
    return tidy(out, "mean_expr")


@query
def cluster_sizes(spark, sf):
    return ag.cluster_sizes(fx.table(spark, sf, "embeddings"), "label")


@query
def distinct_entities(spark, sf):
    return ag.distinct_entities(jn.filter_low_count(fx.counts(spark, sf), fx.MIN_TOTAL, count="n"))


@query
def profile(spark, sf):
    return ag.profile(fx.counts(spark, sf))


@query
def checksum(spark, sf):
    return ag.checksum(fx.normalized(spark, sf), "log2_cpm").select(rounded("checksum", 3).alias("checksum"))


@query
def first_value(spark, sf):
    return ag.first_value(fx.counts(spark, sf), ["gene_id", "sample_id"], "n")


# ---- order and top-k ---------------------------------------------------------------------------


@query
def top_variable(spark, sf):
    return tidy(rk.top_variable(fx.normalized(spark, sf), 100), "variance", "mean_expr")


@query
def top_changed(spark, sf):
    return tidy(rk.top_changed(changes(spark, sf), 50), "max_abs_log2fc")


@query
def ordered_output(spark, sf):
    return rk.ordered(fx.counts(spark, sf), ["gene_id", "hrs", "rep"])


@query
def preview(spark, sf):
    return rk.ordered(fx.counts(spark, sf), ["hrs", "gene_id", "rep"], 10)


@query
def time_axis(spark, sf):
    return rk.time_axis(fx.counts(spark, sf), "hrs")


# ---- sets --------------------------------------------------------------------------------------


@query
def distinct_values(spark, sf):
    return st.distinct_values(fx.table(spark, sf, "lineitem"), ["l_partkey", "l_returnflag"])


@query
def replicate_rows(spark, sf):
    return st.replicate_rows(fx.counts(spark, sf), 5)


@query
def difference(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    columns = ["l_partkey", "l_returnflag"]
    return st.difference(
        lines.select(*columns), lines.filter(F.col("l_linestatus") == "F").select(*columns)
    )


# ---- expressions -------------------------------------------------------------------------------


@query
def expr_cpm_log2(spark, sf):
    sized = jn.attach_library_size(fx.counts(spark, sf), count="n")
    return sized.select(
        "gene_id",
        "sample_id",
        rounded(fn.cpm("n", "library_size")).alias("cpm"),
        rounded(fn.log2p1(fn.cpm("n", "library_size"))).alias("log2_cpm"),
    )


@query
def expr_fold_change_abs(spark, sf):
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded(fn.log2fc("l_discount", "l_tax")).alias("fc"),
        rounded(fn.absolute(fn.log2fc("l_discount", "l_tax"))).alias("abs_fc"),
    )


@query
def expr_casts(spark, sf):
    text = F.col("l_quantity").cast("string")
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.to_int(text).alias("as_int"),
        fn.to_count(text).alias("as_long"),
        fn.to_count("l_returnflag").alias("malformed"),
    )


@query
def expr_array_element(spark, sf):
    values = F.col("embedding").cast("array<double>")
    return fx.table(spark, sf, "embeddings").select(
        "vec_id",
        rounded(fn.element(values, 0)).alias("first"),
        rounded(fn.element(values, 63)).alias("last"),
        fn.element(values, 64).alias("past_end"),
    )


# ---- statistics --------------------------------------------------------------------------------


@query
def standardize(spark, sf):
    out = ml.standardize(fx.normalized(spark, sf))
    return tidy(out.select("gene_id", "sample_id", "z"), "z")


@query
def standardize_vectors(spark, sf):
    scaled = ml.standardize_vectors(fx.vectors(spark, sf))
    return tidy(exploded(scaled, ["vec_id"], "scaled_features"), "value")


@query
def pca_ratios(spark, sf):
    return tidy(ml.fit_pca(fx.vectors(spark, sf), k=5)[1], "ratio")


@query
def pca_coordinates(spark, sf):
    v = fx.vectors(spark, sf)
    model, _ = ml.fit_pca(v, k=5)
    return tidy(ml.sample_coordinates(model, v, 2, ["vec_id"]), "PC1", "PC2")


@query
def cluster_entities(spark, sf):
    return ml.cluster_entities(fx.vectors(spark, sf), "vec_id", k=5).select("vec_id", "cluster")


def planted(spark: SparkSession, sf: str) -> ml.Clusters:
    """Five far groups by the remainder of the part key, with the line totals as noise."""
    lines = fx.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("gene_id"))
    level = F.pmod("gene_id", F.lit(5)) * F.lit(1_000_000.0)
    rows = lines.agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n")).select(
        "gene_id",
        array_to_vector(F.array(level + F.col("q"), F.col("n").cast("double"))).alias("features"),
    )
    return ml.fit_clusters(rows, k=5)


@query
def planted_clusters(spark, sf):
    return planted(spark, sf).rows.select("gene_id", "cluster")


@query
def planted_centres(spark, sf):
    found = planted(spark, sf)
    sizes = ag.cluster_sizes(found.rows, "cluster", "n_entities")
    centres = found.centres.select("cluster", F.posexplode("centre").alias("slot", "value"))
    return tidy(centres.join(sizes, "cluster"), "value")


@query
def cluster_misplaced(spark, sf):
    return ml.misplaced(ml.fit_clusters(fx.vectors(spark, sf), "vec_id", k=5))


@query
def time_cluster_misplaced(spark, sf):
    found = _clusters(spark, sf)
    return ml.misplaced(ml.Clusters(found.vectors, found.centres))


@query
def silhouette(spark, sf):
    return tidy(ml.silhouette(fx.vectors(spark, sf), label="label"), "silhouette")


# ---- batches of samples and all entities ---------------------------------------------------------


def batches(rows: DataFrame) -> dict[str, DataFrame]:
    """Three batches of samples, by time."""
    return {f"b{i}": rows.filter(F.pmod("hrs", F.lit(3)) == i) for i in range(3)}


def batched_counts(spark: SparkSession, sf: str) -> str:
    path = fx.scratch_path(spark, "counts_states")
    for name, rows in batches(fx.counts(spark, sf)).items():
        sa.append_counts(rows, path, name, "n")
    return path


@query
def batched_variability(spark, sf):
    path = fx.scratch_path(spark, "moments")
    for name, rows in batches(fx.normalized(spark, sf)).items():
        sa.append_state(sa.moments(rows), path, name)
    found = sa.variability(sa.merge_moments(sa.read_states(spark, path)))
    return tidy(found, "variance", "mean_expr")


@query
def batched_totals(spark, sf):
    return sa.read_totals(spark, batched_counts(spark, sf))


@query
def batched_libraries(spark, sf):
    return sa.read_libraries(spark, batched_counts(spark, sf))


def bucketed(spark: SparkSession, sf: str) -> DataFrame:
    path = fx.scratch_path(spark, "bucketed")
    write_bucketed(fx.normalized(spark, sf), path, "gene_id", 8)
    return read_bucketed(spark, path, "gene_id", 8)


@query
def bucketed_totals(spark, sf):
    return ag.entity_totals(bucketed(spark, sf), count="n")


@query
def bucketed_variability(spark, sf):
    return tidy(ag.entity_variability(bucketed(spark, sf)), "variance", "mean_expr")


@query
def wide_pca(spark, sf):
    found = pca_over_all(fx.normalized(spark, sf), 5, 2, KEYS)
    return tidy(found.coordinates, "PC1", "PC2")


@query
def wide_pca_ratios(spark, sf):
    return tidy(pca_over_all(fx.normalized(spark, sf), 5, 2, KEYS).ratios, "ratio")


# ---- distinct entities by sketches -------------------------------------------------------------


def _rolled_up(spark: SparkSession, sf: str, keys: list[str]) -> DataFrame:
    """Distinct entities per ``keys`` from sketches of (process, class, time), kept per batch of times
    as Parquet, beside the exact number that they must bound."""
    rows = jn.annotate(fx.normalized(spark, sf), fx.annotation(spark, sf))
    path = fx.scratch_path(spark, "sketches")
    for name, batch in batches(rows).items():
        sa.append_state(sk.entity_sketches(batch, ["process", "class", "hrs"]), path, name)
    found = sk.estimates(sk.roll_up(sa.read_states(spark, path), keys))
    exact = rows.groupBy(*keys).agg(F.count_distinct("gene_id").alias("exact"))
    both = exact.join(found, keys, "full") if keys else exact.crossJoin(found)
    within = F.col("exact").between(F.col("n_genes_low"), F.col("n_genes_high"))
    return both.select(*keys, F.col("exact").alias("n_genes"), within.alias("within_bounds"))


@query
def sketched_by_process_time(spark, sf):
    return _rolled_up(spark, sf, ["process", "hrs"])


@query
def sketched_by_process(spark, sf):
    return _rolled_up(spark, sf, ["process"])


@query
def sketched_by_time(spark, sf):
    return _rolled_up(spark, sf, ["hrs"])


# ---- the largest of every group ----------------------------------------------------------------


@query
def top_variable_per_process(spark, sf):
    top = rk.top_variable_per(fx.normalized(spark, sf), fx.annotation(spark, sf), "process", 10)
    return tidy(top.select("process", "gene_id", "variance", "rank"), "variance")


@query
def top_changed_per_time(spark, sf):
    return tidy(rk.top_changed_per(changes(spark, sf), "hrs", 25), "max_abs_log2fc")


# ---- tables that stay whole --------------------------------------------------------------------


@query
def published_round_trip(spark, sf):
    """The second version, built from the first one while that is the one to read."""
    path = fx.scratch_path(spark, "published")
    publish_table(fx.counts(spark, sf), path, partition_by="hrs")
    doubled = read_published(spark, path).withColumn("n", F.col("n") * 2)
    publish_table(doubled, path, partition_by="hrs")
    return read_published(spark, path, ["gene_id", "sample_id", "hrs", "rep", "n"]).withColumn(
        "n_superseded", F.lit(len(superseded(spark, path)))
    )


@query
def replaced_partitions(spark, sf):
    """Counts of one time replaced by three times their size; the other times stay."""
    path, counts = fx.scratch_path(spark, "replaced"), fx.counts(spark, sf)
    write_table(counts, path, partition_by="hrs")
    again = counts.filter("hrs = 2").withColumn("n", F.col("n") * 3)
    replace_partitions(again, path, "hrs")
    sums = read_table(spark, path).groupBy("hrs").agg(F.sum("n").alias("total_count"))
    return sums.join(partition_rows(spark, path, "hrs"), "hrs")


@query
def many_files_csv(spark, sf):
    """The wide matrix twice, each time in 16 files, the second time with its columns reversed."""
    path, wide = fx.scratch_path(spark, "many"), fx.wide(spark, sf)
    names = [c for c in wide.columns if c != "gene_id"]
    for folder, order in (("a", names), ("b", names[::-1])):
        part = wide.select("gene_id", *order).repartition(16)
        write_result(part.withColumnRenamed("gene_id", ""), f"{path}/{folder}")
    return read_count_matrix(spark, f"{path}/*")


# ---- absent cells as zeros ---------------------------------------------------------------------


@query
def entity_variability_dense(spark, sf):
    return tidy(ag.entity_variability(fx.normalized(spark, sf), absent="zero"), "variance", "mean_expr")


@query
def mean_by_time_dense(spark, sf):
    return tidy(ag.mean_by_time(fx.normalized(spark, sf), t="hrs", absent="zero"), "mean_log2_cpm")


@query
def top_variable_dense(spark, sf):
    top = rk.top_variable(fx.normalized(spark, sf), 100, absent="zero")
    return tidy(top.select("gene_id", "variance"), "variance")


@query
def fold_change_dense(spark, sf):
    found = plans.fold_change(fx.normalized(spark, sf), t="hrs", also=(), absent="zero")
    return tidy(found, "mean_log2_cpm", "ctrl_expr", "log2fc")


# ---- pipelines ---------------------------------------------------------------------------------


@query
def ingest(spark, sf):
    return plans.ingest_files(
        spark, matrix_csv(spark, sf), metadata_csv(spark, sf), fx.scratch_path(spark, "long")
    )


@query
def ingest_long(spark, sf):
    long = text_counts(spark, sf).withColumn("sample_id", F.col("l_linenumber").cast("string"))
    meta = (
        fx.table(spark, sf, "lineitem")
        .groupBy(F.col("l_linenumber").cast("string").alias("sample_id"))
        .agg(F.max("l_linenumber").alias("hours"))
        .filter(F.col("hours") > 1)
    )
    return plans.ingest_long(long, meta, columns=["hours"])


@query
def normalize(spark, sf):
    out = plans.normalize(fx.counts(spark, sf), fx.MIN_TOTAL, count="n", keep=("hrs", "rep"))
    return tidy(out, "cpm", "log2_cpm")


@query
def normalize_unfiltered(spark, sf):
    return tidy(plans.normalize(fx.counts(spark, sf), None, count="n"), "log2_cpm")


@query
def normalize_replicas(spark, sf):
    copies = st.replicate_rows(fx.counts(spark, sf), 3)
    out = plans.normalize(copies, None, sample=["sample_id", "replica"], count="n")
    return tidy(out, "log2_cpm")


@query
def normalize_events(spark, sf):
    out = plans.normalize(fx.event_counts(spark, sf), 10, count="n", keep=("hrs", "rep"))
    return tidy(out, "cpm", "log2_cpm")


@query
def fold_change(spark, sf):
    return tidy(changes(spark, sf), "mean_log2_cpm", "ctrl_expr", "log2fc")


@query
def changed_entities(spark, sf):
    return tidy(plans.changed_entities(changes(spark, sf)), "max_abs_log2fc")


@query
def dynamics(spark, sf):
    return tidy(_dynamics(spark, sf), "mean_log2_cpm")


@query
def sample_pca(spark, sf):
    result = plans.sample_pca(fx.normalized(spark, sf), 100, 5, 2, KEYS)
    return tidy(result.coordinates, "PC1", "PC2")


@query
def sample_pca_ratios(spark, sf):
    return tidy(plans.sample_pca(fx.normalized(spark, sf), 100, 5, 2, KEYS).ratios, "ratio")


def _clusters(spark: SparkSession, sf: str) -> plans.ClusterResult:
    return plans.cluster_time_profiles(fx.normalized(spark, sf), 500, 5, t="hrs")


@query
def time_cluster_labels(spark, sf):
    return _clusters(spark, sf).labels


@query
def time_cluster_profiles(spark, sf):
    return tidy(_clusters(spark, sf).profiles, "mean_expr")


@query
def time_cluster_silhouette(spark, sf):
    return tidy(_clusters(spark, sf).silhouette, "silhouette")


@query
def time_profiles(spark, sf):
    x = fx.normalized(spark, sf)
    return tidy(exploded(plans.time_profiles(x, rk.time_axis(x, "hrs"), t="hrs"), ["gene_id"]), "value")


@query
def time_profiles_centered(spark, sf):
    x = fx.normalized(spark, sf)
    out = plans.time_profiles(x, rk.time_axis(x, "hrs"), t="hrs", center=True)
    return tidy(exploded(out, ["gene_id"]), "value")


@query
def fold_change_for(spark, sf):
    x = fx.normalized(spark, sf)
    out = plans.fold_change_for(x, rk.top_variable(x, 100), t="hrs", also=())
    return tidy(out, "mean_log2_cpm", "ctrl_expr", "log2fc")


# ---- layout ------------------------------------------------------------------------------------


@query
def layout_by_key(spark, sf):
    return ly.layout_by_key(fx.counts(spark, sf), "hrs", 7)


@query
def rebalance(spark, sf):
    return ly.rebalance(fx.counts(spark, sf), 16)


@query
def persist_scope(spark, sf):
    """Rows of the counts next to what two actions over the kept table found."""
    with ly.persist_scope(fx.counts(spark, sf)) as kept:
        rows = kept.count()
        entities = ag.distinct_entities(kept).first()[0]
    return fx.counts(spark, sf).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(rows).cast("bigint").alias("kept_rows"),
        F.lit(entities).cast("bigint").alias("kept_entities"),
    )
