"""DuckDB SQL for the queries. Doubles are rounded to six places on both sides."""

from __future__ import annotations

MIN_TOTAL = 500

C = """
c AS (
  SELECT l_partkey AS gene_id,
         CAST(year(l_shipdate) - 1995 AS INTEGER) AS hrs,
         l_linestatus AS rep,
         CAST(year(l_shipdate) - 1995 AS VARCHAR) || '-' || l_linestatus AS sample_id,
         CAST(SUM(l_quantity) AS BIGINT) AS n
  FROM lineitem GROUP BY ALL
)"""

X = (
    C
    + f""",
kept AS (
  SELECT * FROM c
  WHERE gene_id IN (SELECT gene_id FROM c GROUP BY gene_id HAVING SUM(n) >= {MIN_TOTAL})
),
lib AS (SELECT sample_id, SUM(n)::DOUBLE AS ls FROM kept GROUP BY sample_id),
x AS (
  SELECT gene_id, sample_id, hrs, rep, n,
         n::DOUBLE / ls * 1e6 AS cpm, log2(n::DOUBLE / ls * 1e6 + 1) AS e
  FROM kept JOIN lib USING (sample_id)
)"""
)

MEANS = X + ",\nmeans AS (SELECT gene_id, hrs, AVG(e) AS m FROM x GROUP BY ALL)"

FC = (
    MEANS
    + """,
fc AS (
  SELECT a.gene_id, a.hrs, a.m AS m, b.m AS ctrl, a.m - b.m AS fc
  FROM means a JOIN means b ON a.gene_id = b.gene_id AND b.hrs = 0
  WHERE a.hrs > 0
)"""
)

VARIABILITY = """
SELECT gene_id, VAR_SAMP(e) AS variance, AVG(e) AS mean_expr, COUNT(sample_id) AS n_samples
FROM x GROUP BY gene_id"""

TOP = (
    X
    + f""",
top AS (
  SELECT gene_id FROM ({VARIABILITY})
  ORDER BY variance DESC NULLS LAST, gene_id LIMIT 100
)"""
)

DYN = (
    X
    + """,
dyn AS (
  SELECT p_type AS process, p_brand AS class, hrs,
         AVG(e) AS m, COUNT(DISTINCT gene_id) AS n_genes
  FROM x JOIN part ON p_partkey = gene_id GROUP BY ALL
)"""
)

WIDE = """
w AS (
  SELECT l_partkey AS gene_id,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS BIGINT) AS "A",
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS BIGINT) AS "N",
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS BIGINT) AS "R"
  FROM lineitem GROUP BY l_partkey
)"""

TEXT = """
cells AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS q,
         l_discount = 0 AS blank, l_discount <> 0 AND l_tax = 0 AS bad
  FROM lineitem
)"""

VEC = """
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS emb FROM embeddings),
vl AS (
  SELECT vec_id, CAST(unnest(generate_series(1, len(emb))) AS INTEGER) AS i, unnest(emb) AS val
  FROM v
)"""


def with_(ctes: str, body: str) -> str:
    """A query; a body that starts with a comma goes on listing CTEs."""
    body = body.strip()
    return f"WITH RECURSIVE {ctes.strip()}" + (body if body[0] == "," else "\n" + body)


def r6(expression: str, name: str) -> str:
    return f"ROUND({expression}, 6) + 0.0 AS {name}"


def principal_axes(
    source: str, k: int, squarings: int = 40, cell: str = "COVAR_SAMP(a.val, b.val)"
) -> str:
    """CTEs for the leading eigenpairs of the covariance of ``source`` (row id, i, val), or of the
    matrix with other cells.

    Squaring a symmetric matrix again and again leaves the projector on its leading axis; taking
    that axis out and repeating gives the next one. ``axis1 .. axisk`` hold the loadings, with the
    largest one positive, and the eigenvalue.
    """
    parts = [
        f"""
cov AS (
  SELECT a.i AS i, b.i AS j, {cell} AS c
  FROM {source} a JOIN {source} b USING (id) GROUP BY a.i, b.i
),
total AS (SELECT SUM(c) AS tr FROM cov WHERE i = j),
mat1 AS (
  SELECT list(row_ ORDER BY i) AS m
  FROM (SELECT i, list(c ORDER BY j) AS row_ FROM cov GROUP BY i)
)"""
    ]
    for a in range(1, k + 1):
        parts.append(
            f"""
pow{a}(step, m) AS (
  SELECT 0, m FROM mat{a}
  UNION ALL
  SELECT step + 1,
         list_transform(sq, lambda r: list_transform(r, lambda x:
           x / list_sum(list_transform(generate_series(1, len(sq)), lambda d: sq[d][d]))))
  FROM (
    SELECT step, list_transform(m, lambda r:
             list_transform(m, lambda s: list_dot_product(r, s))) AS sq
    FROM pow{a} WHERE step < {squarings}
  )
),
raw{a} AS (
  SELECT list_transform(m, lambda r: r[best]) AS u
  FROM (
    SELECT m, list_position(diag, list_max(diag)) AS best
    FROM (
      SELECT m, list_transform(generate_series(1, len(m)), lambda d: m[d][d]) AS diag
      FROM pow{a} WHERE step = {squarings}
    )
  )
),
unit{a} AS (
  SELECT list_transform(u, lambda x: x / sqrt(list_dot_product(u, u))) AS u FROM raw{a}
),
axis{a} AS (
  SELECT u, list_dot_product(u, list_transform(m, lambda r: list_dot_product(r, u))) AS ev
  FROM unit{a}, mat{a}
)"""
        )
        if a < k:
            parts.append(
                f"""
mat{a + 1} AS (
  SELECT list_transform(generate_series(1, len(u)), lambda p:
           list_transform(generate_series(1, len(u)), lambda q:
             m[p][q] - ev * u[p] * u[q])) AS m
  FROM mat{a}, axis{a}
)"""
            )
    return ",".join(parts)


def ratio_rows(k: int) -> str:
    rows = [
        f"SELECT CAST({a} AS INTEGER) AS component, {r6('ev / tr', 'ratio')} FROM axis{a}, total"
        for a in range(1, k + 1)
    ]
    return "\nUNION ALL ".join(rows)


Z = (
    TOP
    + """,
slots AS (SELECT gene_id, CAST(ROW_NUMBER() OVER (ORDER BY gene_id) AS INTEGER) AS i FROM top),
meta AS (SELECT DISTINCT sample_id, hrs, rep FROM x),
dense AS (
  SELECT meta.sample_id, meta.hrs, meta.rep, slots.gene_id, slots.i, COALESCE(x.e, 0.0) AS val
  FROM meta CROSS JOIN slots
  LEFT JOIN x ON x.sample_id = meta.sample_id AND x.gene_id = slots.gene_id
),
z AS (
  SELECT sample_id AS id, hrs, rep, i,
         CASE WHEN STDDEV_SAMP(val) OVER w = 0 THEN 0.0
              ELSE (val - AVG(val) OVER w) / STDDEV_SAMP(val) OVER w END AS val
  FROM dense WINDOW w AS (PARTITION BY i)
)"""
)

#: Every entity's z-scores over all samples: row id = entity, i = sample.
WIDE_Z = (
    X
    + """,
meta AS (
  SELECT sample_id, hrs, rep, CAST(ROW_NUMBER() OVER (ORDER BY sample_id) AS INTEGER) AS i
  FROM (SELECT DISTINCT sample_id, hrs, rep FROM x)
),
dense AS (
  SELECT g.gene_id, meta.i, COALESCE(x.e, 0.0) AS val
  FROM (SELECT DISTINCT gene_id FROM x) g CROSS JOIN meta
  LEFT JOIN x ON x.sample_id = meta.sample_id AND x.gene_id = g.gene_id
),
z AS (
  SELECT gene_id AS id, i,
         CASE WHEN STDDEV_SAMP(val) OVER w = 0 THEN 0.0
              ELSE (val - AVG(val) OVER w) / STDDEV_SAMP(val) OVER w END AS val
  FROM dense WINDOW w AS (PARTITION BY gene_id)
)"""
)

PLANTED = """
WITH t AS (
  SELECT l_partkey AS gene_id, SUM(l_quantity) AS q, COUNT(*) AS n FROM lineitem GROUP BY l_partkey
),
l AS (
  SELECT gene_id % 5 AS r, CAST(ROW_NUMBER() OVER (ORDER BY MIN(gene_id)) - 1 AS INTEGER) AS cluster
  FROM t GROUP BY gene_id % 5
),
p AS (SELECT t.*, cluster, 1000000.0 * r + q AS level FROM t JOIN l ON gene_id % 5 = r)
"""



def clustered(points: str, k: int = 5, seed: int = 42, rounds: int = 20) -> str:
    """CTEs that end in ``labels`` (key, f, cluster), the k-means of a table of (key, f)."""

    def race(turn: str, far: str) -> str:
        name = f"md5(concat_ws(':', key::VARCHAR, '{seed}', ({turn})::VARCHAR))"
        return f"-ln((('0x' || substr({name}, 1, 12))::BIGINT + 1) / 281474976710657.0) / {far}"

    def gap(centre: str) -> str:
        pairs = f"list_zip(f, {centre})"
        return f"list_sum(list_transform({pairs}, lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

    return f"""
points AS MATERIALIZED ({points}),
seeds AS (
  SELECT 1 AS i, [arg_min(f, [{race("0", "1.0")}, key::DOUBLE])] AS c FROM points
  UNION ALL
  SELECT i + 1, list_append(ANY_VALUE(c), arg_min(f, [{race("i", "far")}, key::DOUBLE]))
  FROM (SELECT i, c, f, key, list_min(list_transform(c, lambda m: {gap("m")})) AS far FROM seeds, points
        WHERE i < {k})
  WHERE far > 0 GROUP BY i
),
lloyd AS (
  SELECT 0 AS turn, c FROM seeds WHERE i = {k}
  UNION ALL
  SELECT turn + 1, list(m ORDER BY l) FROM (
    SELECT turn, l, list(x ORDER BY slot) AS m FROM (
      SELECT turn, l, slot, AVG(f[slot]) AS x FROM (
        SELECT turn, f, UNNEST(range(1, len(f) + 1)) AS slot,
               list_position(list_transform(c, lambda m: {gap("m")}), list_min(list_transform(c, lambda m: {gap("m")}))) AS l
        FROM lloyd, points WHERE turn < {rounds})
      GROUP BY turn, l, slot)
    GROUP BY turn, l)
  GROUP BY turn
),
placed AS (
  SELECT key, f, list_position(list_transform(c, lambda m: {gap("m")}), list_min(list_transform(c, lambda m: {gap("m")}))) AS l
  FROM lloyd, points WHERE turn = {rounds}
),
labels AS (
  SELECT key, f, CAST(DENSE_RANK() OVER (ORDER BY least) - 1 AS INTEGER) AS cluster
  FROM (SELECT *, MIN(key) OVER (PARTITION BY l) AS least FROM placed)
)"""


TIME_CLUSTERS = (
    MEANS
    + f""",
most AS (
  SELECT gene_id FROM ({VARIABILITY}) ORDER BY variance DESC NULLS LAST, gene_id LIMIT 500
),
axis AS (SELECT DISTINCT hrs FROM x),
"""
    + clustered(
        """
  SELECT most.gene_id AS key, list(COALESCE(m, 0.0) ORDER BY axis.hrs) AS f
  FROM most CROSS JOIN axis
  LEFT JOIN means ON means.gene_id = most.gene_id AND means.hrs = axis.hrs
  GROUP BY most.gene_id"""
    ).strip()
)

SILHOUETTE = f"""
sizes AS (SELECT cluster, COUNT(*) AS n FROM labels GROUP BY cluster),
sums AS (
  SELECT a.key, a.cluster AS own, b.cluster AS other,
         SUM(list_dot_product(a.f, a.f) - 2 * list_dot_product(a.f, b.f) + list_dot_product(b.f, b.f)) AS d
  FROM labels a CROSS JOIN labels b GROUP BY ALL
),
ab AS (
  SELECT key, MAX(CASE WHEN own = other THEN d / (n - 1) END) AS a,
         MIN(CASE WHEN own <> other THEN d / n END) AS b, MAX(CASE WHEN own = other THEN n END) AS size
  FROM sums JOIN sizes ON sizes.cluster = other GROUP BY key
)
SELECT {r6("AVG(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / GREATEST(a, b) END)", "silhouette")}
FROM ab"""

#: Every entity with every sample, the absent ones as zeros.
DENSE = (
    X
    + """,
dense AS (
  SELECT g.gene_id, s.sample_id, s.hrs, COALESCE(x.e, 0.0) AS e
  FROM (SELECT DISTINCT gene_id FROM x) g CROSS JOIN (SELECT DISTINCT sample_id, hrs FROM x) s
  LEFT JOIN x ON x.gene_id = g.gene_id AND x.sample_id = s.sample_id
),
level AS (SELECT gene_id, hrs, AVG(e) AS m FROM dense GROUP BY ALL)"""
)



def bounded(keys: str) -> str:
    return with_(
        X,
        f"""SELECT {keys}, COUNT(DISTINCT gene_id) AS n_genes, TRUE AS within_bounds
FROM (SELECT x.*, p_type AS process FROM x JOIN part ON p_partkey = gene_id) GROUP BY {keys}""",
    )


ORACLES: dict[str, str] = {
    # ---- sketches, the largest of every group, tables that stay whole
    "sketched_by_process_time": bounded("process, hrs"),
    "sketched_by_process": bounded("process"),
    "sketched_by_time": bounded("hrs"),
    "top_variable_per_process": with_(
        X,
        f""",
v AS ({VARIABILITY}),
r AS (SELECT p_type AS process, gene_id, variance,
             CAST(ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY variance DESC NULLS LAST, gene_id)
                  AS INTEGER) AS rank
      FROM v JOIN part ON p_partkey = gene_id)
SELECT process, gene_id, {r6("variance", "variance")}, rank FROM r WHERE rank <= 10""",
    ),
    "top_changed_per_time": with_(
        FC,
        f""",
r AS (SELECT hrs, gene_id, ABS(fc) AS a,
             CAST(ROW_NUMBER() OVER (PARTITION BY hrs ORDER BY ABS(fc) DESC, gene_id) AS INTEGER)
                 AS rank FROM fc)
SELECT hrs, gene_id, {r6("a", "max_abs_log2fc")}, rank FROM r WHERE rank <= 25""",
    ),
    "published_round_trip": with_(
        C, "SELECT gene_id, sample_id, hrs, rep, 2 * n AS n, 1 AS n_superseded FROM c"
    ),
    "replaced_partitions": with_(
        C,
        """SELECT hrs, CAST(SUM(CASE WHEN hrs = 2 THEN 3 * n ELSE n END) AS BIGINT) AS total_count,
       COUNT(*) AS n_rows FROM c GROUP BY hrs""",
    ),
    "many_files_csv": with_(
        WIDE,
        """SELECT CAST(gene_id AS VARCHAR) AS gene_id, CAST("A" AS VARCHAR) AS "A",
       CAST("N" AS VARCHAR) AS "N", CAST("R" AS VARCHAR) AS "R"
FROM w CROSS JOIN (SELECT 1 UNION ALL SELECT 2)""",
    ),
    # ---- batches of samples and all entities
    "batched_variability": with_(
        X,
        f"""SELECT gene_id, {r6("VAR_SAMP(e)", "variance")}, {r6("AVG(e)", "mean_expr")},
       COUNT(*) AS n_samples FROM x GROUP BY gene_id""",
    ),
    "batched_totals": with_(
        C, "SELECT gene_id, CAST(SUM(n) AS BIGINT) AS total_count FROM c GROUP BY gene_id"
    ),
    "batched_libraries": with_(
        C, "SELECT sample_id, CAST(SUM(n) AS BIGINT) AS library_size FROM c GROUP BY sample_id"
    ),
    "bucketed_totals": with_(
        X, "SELECT gene_id, CAST(SUM(n) AS BIGINT) AS total_count FROM x GROUP BY gene_id"
    ),
    "bucketed_variability": with_(
        X,
        f"""SELECT gene_id, {r6("VAR_SAMP(e)", "variance")}, {r6("AVG(e)", "mean_expr")},
       COUNT(*) AS n_samples FROM x GROUP BY gene_id""",
    ),
    "wide_pca": with_(
        WIDE_Z + "," + principal_axes("z", 2, cell="SUM(a.val * b.val)"),
        f""",
loads AS (
  SELECT id, SUM(val * axis1.u[i]) AS l1, SUM(val * axis2.u[i]) AS l2 FROM z, axis1, axis2 GROUP BY id
),
signs AS (
  SELECT SIGN(ARG_MAX(l1, ABS(l1))) AS s1, SIGN(ARG_MAX(l2, ABS(l2))) AS s2 FROM loads
)
SELECT sample_id, hrs, rep, {r6("s1 * axis1.u[i] * SQRT(axis1.ev)", '"PC1"')},
       {r6("s2 * axis2.u[i] * SQRT(axis2.ev)", '"PC2"')}
FROM meta, axis1, axis2, signs""",
    ),
    "wide_pca_ratios": with_(
        WIDE_Z + "," + principal_axes("z", 5, cell="SUM(a.val * b.val)"), ratio_rows(5)
    ),
    # ---- absent cells as zeros
    "entity_variability_dense": with_(
        DENSE,
        f"""SELECT gene_id, {r6("VAR_SAMP(e)", "variance")}, {r6("AVG(e)", "mean_expr")},
       COUNT(*) AS n_samples FROM dense GROUP BY gene_id""",
    ),
    "mean_by_time_dense": with_(DENSE, f"SELECT gene_id, hrs, {r6('m', 'mean_log2_cpm')} FROM level"),
    "top_variable_dense": with_(
        DENSE,
        f"""SELECT gene_id, {r6("variance", "variance")} FROM (
  SELECT gene_id, VAR_SAMP(e) AS variance FROM dense GROUP BY gene_id
  ORDER BY variance DESC, gene_id LIMIT 100)""",
    ),
    "fold_change_dense": with_(
        DENSE,
        f"""SELECT a.gene_id, a.hrs, {r6("a.m", "mean_log2_cpm")}, {r6("b.m", "ctrl_expr")},
       {r6("a.m - b.m", "log2fc")}
FROM level a JOIN level b ON a.gene_id = b.gene_id AND b.hrs = 0 WHERE a.hrs > 0""",
    ),
    # ---- k-means
    "cluster_entities": with_(
        clustered("SELECT vec_id AS key, embedding::DOUBLE[] AS f FROM embeddings"),
        "SELECT key AS vec_id, cluster FROM labels",
    ),
    "time_cluster_labels": with_(TIME_CLUSTERS, "SELECT key AS gene_id, cluster FROM labels"),
    "time_cluster_profiles": with_(
        TIME_CLUSTERS,
        f"""SELECT cluster, hrs, {r6("AVG(m)", "mean_expr")}, ANY_VALUE(size) AS n_entities
FROM means JOIN (SELECT key, cluster, COUNT(*) OVER (PARTITION BY cluster) AS size FROM labels)
  ON key = gene_id
GROUP BY cluster, hrs""",
    ),
    "time_cluster_silhouette": with_(TIME_CLUSTERS, "," + SILHOUETTE),
    "planted_clusters": PLANTED + "SELECT gene_id, cluster FROM p",
    "planted_centres": PLANTED
    + f"""SELECT cluster, 0 AS slot, COUNT(*) AS n_entities, {r6("AVG(level)", "value")}
FROM p GROUP BY cluster
UNION ALL SELECT cluster, 1, COUNT(*), {r6("AVG(n)", "value")} FROM p GROUP BY cluster""",
    "cluster_misplaced": """SELECT COUNT(*) AS n_entities, CAST(5 AS BIGINT) AS n_clusters,
       CAST(0 AS BIGINT) AS n_misplaced FROM embeddings""",
    "time_cluster_misplaced": with_(
        X,
        """SELECT LEAST(500, COUNT(DISTINCT gene_id)) AS n_entities, CAST(5 AS BIGINT) AS n_clusters,
       CAST(0 AS BIGINT) AS n_misplaced FROM x""",
    ),
    # ---- sources and sinks
    "sample_metadata_csv": with_(
        C,
        """SELECT DISTINCT 'lib ' || sample_id AS full_sample_name, rep AS replicate,
       CAST(hrs + 1 AS INTEGER) AS time_point, hrs AS hours,
       CAST(hrs AS VARCHAR) || ' h' AS time_label, sample_id FROM c""",
    ),
    "count_matrix_csv": with_(
        WIDE,
        """SELECT CAST(gene_id AS VARCHAR) AS gene_id, CAST("A" AS VARCHAR) AS "A",
       CAST("N" AS VARCHAR) AS "N", CAST("R" AS VARCHAR) AS "R" FROM w""",
    ),
    "table_scan": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem",
    "table_round_trip": with_(C, "SELECT gene_id, sample_id, hrs, rep, n FROM c"),
    "result_round_trip": with_(
        C, "SELECT gene_id, CAST(SUM(n) AS BIGINT) AS total_count FROM c GROUP BY gene_id"
    ),
    "annotation_csv": """SELECT 'sym' || CAST(p_partkey AS VARCHAR) AS "Symbol",
       CAST(p_partkey AS VARCHAR) AS gene_id, p_brand AS functional_class,
       p_type AS immune_process FROM part""",
    "result_as_lookup": with_(
        TOP, "SELECT gene_id, sample_id, n FROM x WHERE gene_id IN (SELECT gene_id FROM top)"
    ),
    # ---- projection and filter
    "known_samples": with_(WIDE, 'SELECT gene_id, "A", "R" FROM w'),
    "clean_counts": with_(
        TEXT,
        """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN bad THEN NULL ELSE q END AS raw_count
FROM cells WHERE NOT blank""",
    ),
    "cell_report": with_(
        TEXT,
        """SELECT COUNT(*) AS cells, COUNT(*) FILTER (WHERE blank) AS blank,
       COUNT(*) FILTER (WHERE bad) AS malformed FROM cells""",
    ),
    "project_rename": """SELECT l_partkey AS gene_id, l_linestatus AS replicate,
       l_quantity AS raw_count FROM lineitem""",
    "scalar_predicates": with_(
        C,
        "SELECT gene_id, sample_id, hrs, rep, n FROM c WHERE n >= 50 AND hrs > 0 AND rep = 'F'",
    ),
    "restrict_to": with_(
        TOP, "SELECT gene_id, sample_id, n FROM x WHERE gene_id IN (SELECT gene_id FROM top)"
    ),
    "fill_missing": with_(
        C,
        """,
g AS (SELECT DISTINCT gene_id FROM c),
r AS (SELECT DISTINCT hrs AS t FROM c)
SELECT g.gene_id, CAST(t AS VARCHAR) AS hrs, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n
FROM g CROSS JOIN r
LEFT JOIN c ON c.gene_id = g.gene_id AND c.hrs = t GROUP BY ALL""",
    ),
    # ---- reshape
    "melt_matrix": with_(
        WIDE,
        """SELECT gene_id, k AS sample_id, v AS raw_count
FROM w UNPIVOT INCLUDE NULLS (v FOR k IN ("A", "N", "R"))""",
    ),
    "melt_with_gaps": with_(
        C,
        """,
g AS (SELECT DISTINCT gene_id FROM c),
r AS (SELECT DISTINCT hrs AS t FROM c)
SELECT g.gene_id, CAST(t AS VARCHAR) AS hrs, CAST(SUM(n) AS BIGINT) AS n
FROM g CROSS JOIN r
LEFT JOIN c ON c.gene_id = g.gene_id AND c.hrs = t GROUP BY ALL""",
    ),
    "pivot_samples": with_(
        Z,
        f"""SELECT sample_id, hrs, rep, CAST(gene_id AS VARCHAR) AS gene_id, {r6("val", "value")}
FROM dense""",
    ),
    "pivot_time": with_(
        MEANS,
        f""",
g AS (SELECT DISTINCT gene_id FROM means),
r AS (SELECT DISTINCT hrs AS t FROM means)
SELECT g.gene_id, CAST(t AS VARCHAR) AS hrs, {r6("COALESCE(MAX(m), 0.0)", "level")}
FROM g CROSS JOIN r
LEFT JOIN means ON means.gene_id = g.gene_id AND means.hrs = t GROUP BY g.gene_id, t""",
    ),
    "heat_matrix": with_(
        FC,
        f""",
g AS (SELECT gene_id FROM fc GROUP BY gene_id ORDER BY MAX(ABS(fc)) DESC, gene_id LIMIT 50),
r AS (SELECT DISTINCT hrs AS t FROM fc)
SELECT g.gene_id, CAST(t AS VARCHAR) AS hrs, {r6("AVG(fc)", "log2fc")}
FROM g CROSS JOIN r LEFT JOIN fc ON fc.gene_id = g.gene_id AND fc.hrs = t GROUP BY g.gene_id, t""",
    ),
    "assemble": with_(
        WIDE,
        """SELECT gene_id, CAST(0 AS INTEGER) AS slot, "A"::DOUBLE AS value FROM w
UNION ALL SELECT gene_id, 1, "N"::DOUBLE FROM w UNION ALL SELECT gene_id, 2, "R"::DOUBLE FROM w""",
    ),
    "long_to_vector": with_(
        Z,
        f"""SELECT sample_id, hrs, rep, CAST(i - 1 AS INTEGER) AS slot, {r6("val", "value")}
FROM dense""",
    ),
    "vector_columns": with_(
        VEC,
        f"SELECT vec_id, label, {r6('emb[1]', chr(34) + 'PC1' + chr(34))}, "
        f"{r6('emb[2]', chr(34) + 'PC2' + chr(34))} FROM v",
    ),
    # ---- joins
    "attach_metadata": with_(C, "SELECT sample_id, gene_id, n, hrs, rep FROM c WHERE hrs < 6"),
    "filter_low_count": with_(X, "SELECT gene_id, sample_id, hrs, rep, n FROM kept"),
    "attach_library_size": with_(
        C,
        """SELECT c.*, ls AS library_size FROM c
JOIN (SELECT sample_id, CAST(SUM(n) AS BIGINT) AS ls FROM c GROUP BY sample_id)
USING (sample_id)""",
    ),
    "attach_baseline": with_(
        FC,
        f"""SELECT gene_id, hrs, {r6("m", "mean_log2_cpm")}, {r6("ctrl", "ctrl_expr")}
FROM fc""",
    ),
    "without_baseline": with_(
        MEANS,
        """SELECT COUNT(*) AS n_entities, COUNT(*) FILTER (WHERE first_t > 0) AS n_dropped
FROM (SELECT gene_id, MIN(hrs) AS first_t FROM means GROUP BY gene_id)""",
    ),
    "annotate": with_(
        X,
        """SELECT gene_id, sample_id, n, p_type AS process, p_brand AS class
FROM x JOIN part ON p_partkey = gene_id""",
    ),
    "attach_labels": with_(
        X, "SELECT gene_id, sample_id, n, CAST(gene_id % 5 AS INTEGER) AS cluster FROM x"
    ),
    "missing_samples": """SELECT DISTINCT p_brand AS sample_id FROM part
WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 49)""",
    # ---- aggregates
    "entity_totals": with_(
        C, "SELECT gene_id, CAST(SUM(n) AS BIGINT) AS total_count FROM c GROUP BY gene_id"
    ),
    "library_sizes": with_(
        C, "SELECT sample_id, CAST(SUM(n) AS BIGINT) AS library_size FROM c GROUP BY sample_id"
    ),
    "entity_variability": with_(
        X,
        f"""SELECT gene_id, {r6("variance", "variance")}, {r6("mean_expr", "mean_expr")},
       n_samples FROM ({VARIABILITY})""",
    ),
    "mean_by_time": with_(MEANS, f"SELECT gene_id, hrs, {r6('m', 'mean_log2_cpm')} FROM means"),
    "max_abs_change": with_(
        FC, f"SELECT gene_id, {r6('MAX(ABS(fc))', 'max_abs_log2fc')} FROM fc GROUP BY gene_id"
    ),
    "annotation_dynamics": with_(
        DYN, f"SELECT process, class, hrs, {r6('m', 'mean_log2_cpm')}, n_genes FROM dyn"
    ),
    "process_trajectory": with_(
        DYN, f"SELECT process, hrs, {r6('AVG(m)', 'mean_log2_cpm')} FROM dyn GROUP BY ALL"
    ),
    "process_trajectory_weighted": with_(
        DYN,
        f"""SELECT process, hrs, {r6("SUM(m * n_genes) / SUM(n_genes)", "mean_log2_cpm")}
FROM dyn GROUP BY process, hrs""",
    ),
    "cluster_profiles": with_(
        MEANS,
        f"""SELECT CAST(gene_id % 5 AS INTEGER) AS cluster, hrs, {r6("AVG(m)", "mean_expr")},
       ANY_VALUE(size) AS n_entities
FROM means JOIN (
  SELECT gene_id % 5 AS g, COUNT(DISTINCT gene_id) AS size FROM x GROUP BY 1
) ON g = gene_id % 5
GROUP BY 1, 2""",
    ),
    "cluster_sizes": "SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label",
    "distinct_entities": with_(X, "SELECT COUNT(DISTINCT gene_id) AS n_entities FROM kept"),
    "profile": with_(
        C,
        """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT gene_id) AS n_entities,
       COUNT(DISTINCT sample_id) AS n_samples FROM c""",
    ),
    "checksum": with_(X, "SELECT ROUND(SUM(e), 3) + 0.0 AS checksum FROM x"),
    "first_value": with_(
        C, "SELECT gene_id, sample_id, MAX(n) AS value FROM c GROUP BY gene_id, sample_id"
    ),
    # ---- order and top-k
    "top_variable": with_(
        TOP,
        f"""SELECT gene_id, {r6("variance", "variance")}, {r6("mean_expr", "mean_expr")}, n_samples
FROM ({VARIABILITY}) WHERE gene_id IN (SELECT gene_id FROM top)""",
    ),
    "top_changed": with_(
        FC,
        f"""SELECT gene_id, {r6("a", "max_abs_log2fc")}
FROM (SELECT gene_id, MAX(ABS(fc)) AS a FROM fc GROUP BY gene_id)
ORDER BY a DESC, gene_id LIMIT 50""",
    ),
    "ordered_output": with_(
        C, "SELECT gene_id, sample_id, hrs, rep, n FROM c ORDER BY gene_id, hrs, rep"
    ),
    "preview": with_(
        C, "SELECT gene_id, sample_id, hrs, rep, n FROM c ORDER BY hrs, gene_id, rep LIMIT 10"
    ),
    "time_axis": with_(C, "SELECT DISTINCT hrs FROM c ORDER BY hrs"),
    # ---- sets
    "distinct_values": "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem",
    "replicate_rows": with_(
        C,
        """SELECT gene_id, sample_id, hrs, rep, n, CAST(r.k AS BIGINT) AS replica
FROM c CROSS JOIN range(5) AS r(k)""",
    ),
    "difference": """SELECT l_partkey, l_returnflag FROM lineitem
EXCEPT ALL SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'""",
    # ---- expressions
    "expr_cpm_log2": with_(
        C,
        f"""SELECT gene_id, sample_id, {r6("n::DOUBLE / ls * 1e6", "cpm")},
       {r6("log2(n::DOUBLE / ls * 1e6 + 1)", "log2_cpm")}
FROM c JOIN (SELECT sample_id, SUM(n)::DOUBLE AS ls FROM c GROUP BY sample_id) USING (sample_id)""",
    ),
    "expr_fold_change_abs": f"""SELECT l_orderkey, l_linenumber, {r6("l_discount - l_tax", "fc")},
       {r6("ABS(l_discount - l_tax)", "abs_fc")} FROM lineitem""",
    "expr_casts": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS as_int,
       CAST(l_quantity AS BIGINT) AS as_long, CAST(NULL AS BIGINT) AS malformed FROM lineitem""",
    "expr_array_element": with_(
        VEC,
        f"""SELECT vec_id, {r6("emb[1]", "first")}, {r6("emb[64]", "last")}, emb[65] AS past_end
FROM v""",
    ),
    # ---- statistics
    "standardize": with_(
        X,
        f"""SELECT gene_id, sample_id,
       {r6("CASE WHEN COALESCE(s, 0) = 0 THEN 0.0 ELSE (e - a) / s END", "z")}
FROM (
  SELECT gene_id, sample_id, e, AVG(e) OVER w AS a, STDDEV_SAMP(e) OVER w AS s
  FROM x WINDOW w AS (PARTITION BY gene_id)
)""",
    ),
    "standardize_vectors": with_(
        VEC,
        f"""SELECT vec_id, CAST(i - 1 AS INTEGER) AS slot,
       {r6("(val - AVG(val) OVER w) / STDDEV_SAMP(val) OVER w", "value")}
FROM vl WINDOW w AS (PARTITION BY i)""",
    ),
    "pca_ratios": with_(
        VEC
        + ",\nsrc AS (SELECT vec_id AS id, i, val FROM vl),"
        + principal_axes("src", 5),
        ratio_rows(5),
    ),
    "pca_coordinates": with_(
        VEC
        + ",\nsrc AS (SELECT vec_id AS id, i, val FROM vl),"
        + principal_axes("src", 2),
        f"""SELECT vec_id, {r6("list_dot_product(emb, axis1.u)", '"PC1"')},
       {r6("list_dot_product(emb, axis2.u)", '"PC2"')}
FROM v, axis1, axis2""",
    ),
    "silhouette": with_(
        VEC,
        f""",
sizes AS (SELECT label, COUNT(*) AS n FROM v GROUP BY label),
sums AS (
  SELECT a.vec_id, a.label AS own, b.label AS other,
         SUM(list_dot_product(a.emb, a.emb) - 2 * list_dot_product(a.emb, b.emb)
             + list_dot_product(b.emb, b.emb)) AS d
  FROM v a CROSS JOIN v b GROUP BY ALL
),
ab AS (
  SELECT vec_id,
         MAX(CASE WHEN own = other THEN d / (n - 1) END) AS a,
         MIN(CASE WHEN own <> other THEN d / n END) AS b,
         MAX(CASE WHEN own = other THEN n END) AS size
  FROM sums JOIN sizes ON sizes.label = sums.other GROUP BY vec_id
)
SELECT {r6("AVG(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / GREATEST(a, b) END)", "silhouette")}
FROM ab""",
    ),
    # ---- pipelines
    "ingest": with_(
        C,
        """SELECT sample_id, CAST(gene_id AS VARCHAR) AS gene_id, n AS raw_count, hrs AS hours,
       CAST(hrs + 1 AS INTEGER) AS time_point, rep AS replicate,
       CAST(hrs AS VARCHAR) || ' h' AS time_label FROM c""",
    ),
    "ingest_long": with_(
        TEXT,
        """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN bad THEN NULL ELSE q END AS raw_count,
       CAST(l_linenumber AS VARCHAR) AS sample_id, l_linenumber AS hours
FROM cells WHERE NOT blank AND l_linenumber > 1""",
    ),
    "normalize": with_(
        X,
        f"""SELECT gene_id, sample_id, hrs, rep, n, {r6("cpm", "cpm")}, {r6("e", "log2_cpm")}
FROM x""",
    ),
    "normalize_unfiltered": with_(
        C,
        f"""SELECT gene_id, sample_id, hrs, rep, n, CAST(ls AS BIGINT) AS lib_size,
       {r6("log2(n::DOUBLE / ls * 1e6 + 1)", "log2_cpm")}
FROM c JOIN (SELECT sample_id, SUM(n)::DOUBLE AS ls FROM c GROUP BY sample_id) USING (sample_id)""",
    ),
    "normalize_replicas": with_(
        C,
        f"""SELECT gene_id, sample_id, hrs, rep, n, CAST(r.k AS BIGINT) AS replica,
       CAST(ls AS BIGINT) AS lib_size, {r6("log2(n::DOUBLE / ls * 1e6 + 1)", "log2_cpm")}
FROM c JOIN (SELECT sample_id, SUM(n)::DOUBLE AS ls FROM c GROUP BY sample_id) USING (sample_id)
CROSS JOIN range(3) AS r(k)""",
    ),
    "normalize_events": f"""
WITH c AS (
  SELECT user_id AS gene_id, CAST(dayofyear(ts) AS INTEGER) AS hrs, event_type AS rep,
         CAST(dayofyear(ts) AS VARCHAR) || '-' || event_type AS sample_id, COUNT(*) AS n
  FROM events GROUP BY ALL
),
kept AS (
  SELECT * FROM c WHERE gene_id IN (SELECT gene_id FROM c GROUP BY gene_id HAVING SUM(n) >= 10)
),
lib AS (SELECT sample_id, SUM(n)::DOUBLE AS ls FROM kept GROUP BY sample_id)
SELECT gene_id, sample_id, hrs, rep, n, {r6("n::DOUBLE / ls * 1e6", "cpm")},
       {r6("log2(n::DOUBLE / ls * 1e6 + 1)", "log2_cpm")}
FROM kept JOIN lib USING (sample_id)""",
    "fold_change": with_(
        FC,
        f"""SELECT gene_id, hrs, {r6("m", "mean_log2_cpm")}, {r6("ctrl", "ctrl_expr")},
       {r6("fc", "log2fc")} FROM fc""",
    ),
    "changed_entities": with_(
        FC,
        f"""SELECT gene_id, {r6("MAX(ABS(fc))", "max_abs_log2fc")}
FROM fc GROUP BY gene_id HAVING MAX(ABS(fc)) > 1""",
    ),
    "dynamics": with_(
        DYN, f"SELECT process, class, hrs, {r6('m', 'mean_log2_cpm')}, n_genes FROM dyn"
    ),
    "sample_pca": with_(
        Z + "," + principal_axes("z", 2),
        f"""SELECT id AS sample_id, hrs, rep, {r6("SUM(val * axis1.u[i])", '"PC1"')},
       {r6("SUM(val * axis2.u[i])", '"PC2"')}
FROM z, axis1, axis2 GROUP BY id, hrs, rep""",
    ),
    "sample_pca_ratios": with_(Z + "," + principal_axes("z", 5), ratio_rows(5)),
    "time_profiles": with_(
        MEANS,
        f""",
g AS (SELECT DISTINCT gene_id FROM means),
h AS (SELECT hrs, CAST(ROW_NUMBER() OVER (ORDER BY hrs) - 1 AS INTEGER) AS slot
      FROM (SELECT DISTINCT hrs FROM means))
SELECT g.gene_id, h.slot, {r6("COALESCE(m, 0.0)", "value")}
FROM g CROSS JOIN h LEFT JOIN means ON means.gene_id = g.gene_id AND means.hrs = h.hrs""",
    ),
    "time_profiles_centered": with_(
        MEANS,
        f""",
g AS (SELECT gene_id, AVG(m) AS own FROM means GROUP BY gene_id),
h AS (SELECT hrs, CAST(ROW_NUMBER() OVER (ORDER BY hrs) - 1 AS INTEGER) AS slot
      FROM (SELECT DISTINCT hrs FROM means))
SELECT g.gene_id, h.slot, {r6("COALESCE(m - own, 0.0)", "value")}
FROM g CROSS JOIN h LEFT JOIN means ON means.gene_id = g.gene_id AND means.hrs = h.hrs""",
    ),
    "fold_change_for": with_(
        FC + ",\n" + TOP[len(X) + 2 :].strip(),
        f"""SELECT gene_id, hrs, {r6("m", "mean_log2_cpm")}, {r6("ctrl", "ctrl_expr")},
       {r6("fc", "log2fc")} FROM fc WHERE gene_id IN (SELECT gene_id FROM top)""",
    ),
    # ---- layout
    "layout_by_key": with_(C, "SELECT gene_id, sample_id, hrs, rep, n FROM c"),
    "rebalance": with_(C, "SELECT gene_id, sample_id, hrs, rep, n FROM c"),
    "persist_scope": with_(
        C,
        """SELECT COUNT(*) AS n_rows, COUNT(*) AS kept_rows,
       COUNT(DISTINCT gene_id) AS kept_entities FROM c""",
    ),
}
