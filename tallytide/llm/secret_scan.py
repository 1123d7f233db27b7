"""Secrets in text, told apart from widely copied examples by who owns them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallytide.llm.common import written
from tallytide.operators.sizing import lookup_join

COPIED_FROM = 3


class Kind(NamedTuple):
    """A pattern, the group that holds the secret, and the least length of that group."""

    name: str
    pattern: str
    group: int
    least: int


#: The base kinds in their order.
BASE = (
    Kind(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Kind("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    Kind("hex", r"([0-9a-f]+)", 1, 16),
)
#: What ownership may add: opaque runs with both letters and digits.
OPAQUE = Kind("owned", r"([A-Za-z0-9+/_-]{20,})", 1, 20)
KINDS = (*BASE, OPAQUE)
#: A repeated character or the usual fillers mark a value as no real credential.
FILLER = r"(?i)(.)\1{7,}|example|placeholder|changeme|your[_-]?|xxxx|0123456789|abcdefghij"


def _search(kind: Kind) -> str:
    """The pattern with the length in it where that finds the same matches.

    A run of one character class that is too short holds no longer match, so hex and access keys can
    be looked for by length. An assignment that is too short may swallow the start of another one.
    """
    if kind.name == "assign" or kind is OPAQUE:
        return kind.pattern
    less = 4 if kind.name == "access" else 0
    return kind.pattern.replace("+)", f"{{{kind.least - less},}})")


def _found(text: Column, kind: Kind) -> Column:
    """Matches in order, each as (kind, pos, gap before it, length, value).

    Spark has no function for places of matches; they follow from the lengths of the matches and of
    what ``split`` leaves between them.
    """
    pattern = F.lit(_search(kind))
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group > 1 else hits
    order = F.lit(KINDS.index(kind))
    gaps = F.split(text, _search(kind), -1)
    if kind.group > 1:
        zipped = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), values.alias("value"))
        value = "value"
    else:
        zipped = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"))
        value = "hit"
    rows = F.transform(
        F.slice(zipped, 1, F.size(hits)),
        lambda z, i: F.struct(
            order.alias("kind"),
            i.alias("pos"),
            F.length(z["gap"]).alias("gap"),
            F.length(z["hit"]).alias("size"),
            z[value].alias("value"),
        ),
    )
    return F.when(F.size(hits) > 0, rows).otherwise(
        F.array().cast("array<struct<kind:int,pos:int,gap:int,size:int,value:string>>")
    )


def candidates(
    docs: DataFrame, doc_id: str, text: str, repository: Column, owner: Column
) -> DataFrame:
    """All candidate spans (row, doc_id, repository, owner, kind, value, start, end).

    Rows without any have one line with a null kind. Places count code points, the end is exclusive.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(*[_found(body, k) for k in KINDS])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        repository.cast("string").alias("repository"),
        owner.cast("string").alias("owner"),
        found.alias("found"),
    )
    rows = rows.select("row", "doc_id", "repository", "owner", F.explode_outer("found").alias("f"))
    rows = written(rows.select("row", "doc_id", "repository", "owner", "f.*"), "candidates")
    before = Window.partitionBy("row", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind") + 1)
    opaque = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    enough = (F.length("value") >= least) & ((F.col("kind") < len(BASE)) | opaque)
    return (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("kind", F.when(enough, F.col("kind")))
        .drop("pos", "gap", "size")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(value_sha256, spans, repositories, owners) over the whole corpus.

    Counted in two steps, first per (value, repository, owner), so a value copied into a third of
    all rows is combined in the map tasks.
    """
    once = spans.groupBy("value_sha256", "repository", "owner").agg(F.count("*").alias("n"))
    return once.groupBy("value_sha256").agg(
        F.sum("n").alias("spans"),
        F.count_distinct("repository").alias("repositories"),
        F.count_distinct("owner").alias("owners"),
    )


def scan_secrets(
    docs: DataFrame,
    repository: Column,
    owner: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    copied_from: int = COPIED_FROM,
) -> DataFrame:
    """Findings: row, doc_id, kind, start, end, value_sha256, repositories, owners, verdict.

    Base kinds are always reported. Other opaque runs are added as kind ``owned`` when ownership
    makes them look live and they do not overlap a base span. The verdict of a value is ``copied``
    when at least ``copied_from`` owners hold it, ``filler`` when it looks like a stand-in, else
    ``live``. Hashes are counted, values themselves are not returned.

    Every input row has at least one line; without findings its kind is null, as for null and empty
    texts. Null repositories and owners are not counted as owners. Repeated rows are told apart by
    ``row``, null ids are kept. An empty table gives an empty result; other columns are ignored.
    """
    spans = candidates(docs, doc_id, text, repository, owner)
    hashed = F.sha2(F.col("value"), 256)
    spans = spans.withColumns(
        {
            "value_sha256": F.when(F.col("kind").isNotNull(), hashed),
            "filler": F.col("value").rlike(FILLER),
        }
    )
    spans = written(spans.drop("value"), "spans")
    owned = ownership(spans.filter("kind IS NOT NULL"))
    named = lookup_join(
        spans.filter("kind IS NOT NULL").drop("repository", "owner"),
        owned,
        "value_sha256",
        rows="spans",
    )
    verdict = (
        F.when(F.col("owners") >= copied_from, "copied").when(F.col("filler"), "filler").otherwise("live")
    )
    named = named.withColumn("verdict", verdict)
    in_order = Window.partitionBy("row").orderBy("start")
    is_base = F.col("kind") < len(BASE)
    upto = in_order.rangeBetween(Window.unboundedPreceding, 0)
    onward = in_order.rangeBetween(0, Window.unboundedFollowing)
    reaches = F.max(F.when(is_base, F.col("end"))).over(upto)
    follows = F.min(F.when(is_base, F.col("start"))).over(onward)
    free = (F.coalesce(reaches, F.lit(0)) <= F.col("start")) & (
        F.coalesce(follows, F.col("end")) >= F.col("end")
    )
    kept = named.withColumn("free", free).filter(is_base | (F.col("free") & (verdict == "live")))
    columns = ["row", "doc_id", "kind", "start", "end", "value_sha256", "repositories", "owners"]
    columns.append("verdict")
    found = kept.select(*columns)
    all_rows = spans.select("row", "doc_id").distinct()
    nothing = {c: F.lit(None).cast(dict(found.dtypes)[c]) for c in columns[2:]}
    return found.unionByName(all_rows.withColumns(nothing))


def summarize(findings: DataFrame) -> DataFrame:
    """One row per scanned row: counts by base kind, digest of the base spans, all spans, live ones."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    entry = F.when(
        F.col("kind").isNotNull(),
        F.struct("start", "kind", F.col("end").alias("end")),
    )
    joined = findings.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        *[
            F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k.name}")
            for i, k in enumerate(BASE)
        ],
        F.sort_array(F.collect_list(entry)).alias("found"),
        F.count(F.when(F.col("verdict") == "live", 1)).alias("n_live"),
        F.count(F.when(F.col("verdict") == "copied", 1)).alias("n_copied"),
    )

    def text(found: Column) -> Column:
        return F.array_join(
            F.transform(
                found,
                lambda s: F.concat_ws(
                    ":",
                    F.element_at(names, s["kind"] + 1),
                    s["start"].cast("string"),
                    s["end"].cast("string"),
                ),
            ),
            ",",
        )

    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return joined.select(
        "doc_id",
        *[f"n_{k.name}" for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
        "n_live",
        "n_copied",
    )
