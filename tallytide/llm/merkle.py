"""Merkle trees of documents: equal roots are equal texts, differing branches are edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import written
from tallytide.operators.sizing import lookup_join

#: A section is a line. A paragraph is a run of a line up to a mark before a space, so that text
#: without line breaks has branches too. Both cuts drop one known character, so none is lost.
SECTION = "\n"
PARAGRAPH = r"(?<=[^\p{L}\p{N}\s]) "
#: Low bits of a code that hold a length; a longer leaf has several codes.
LENGTH_BITS = 12


def sections(text: Column) -> Column:
    """Paragraphs of each section: array of arrays of text."""
    return F.transform(F.split(text, SECTION, -1), lambda s: F.split(s, PARAGRAPH, -1))


def _joined(level: str, digests: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.array_join(digests, "")), 256)


def _leaves(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda p: F.sha2(F.concat(F.lit("p"), p), 256))


def tree(text: Column) -> Column:
    """Section digests over paragraph digests: array of (digest, leaves)."""
    return F.transform(
        F.transform(sections(text), _leaves),
        lambda leaves: F.struct(_joined("s", leaves).alias("digest"), leaves.alias("leaves")),
    )


def root(text: Column) -> Column:
    """The root digest: of the section digests, which are of the paragraph digests."""
    return _joined("r", F.transform(sections(text), lambda p: _joined("s", _leaves(p))))


def leaf_codes(text: Column) -> Column:
    """The distinct leaves as longs: a hash above, the length in the low bits.

    A leaf longer than these can hold has one code for each part of its length, with hashes of the
    whole leaf and the number of the part, so that equal leaves share all of them and others none.
    """
    limit = (1 << LENGTH_BITS) - 1

    def codes(p: Column) -> Column:
        last = F.floor((F.length(p) - 1) / limit).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda k: F.xxhash64(p, k)
            .bitwiseAND(F.lit(~limit))
            .bitwiseOR(F.least(F.length(p) - k * limit, F.lit(limit)).cast("bigint")),
        )

    return F.array_distinct(F.flatten(F.transform(F.flatten(sections(text)), codes)))


def _weight(codes: Column) -> Column:
    limit = F.lit((1 << LENGTH_BITS) - 1)
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c.bitwiseAND(limit))


def likeness(a: Column, b: Column) -> Column:
    """Share of the text of both trees, by length, that lies in leaves of both; 0 to 1."""
    total = _weight(a) + _weight(b)
    shared = _weight(F.array_intersect(a, b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * shared / total)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, root and tree of every row; null texts are empty, which is one empty paragraph."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), root(body).alias("root"), tree(body).alias("sections")
    )


def changed_sections(old: Column, new: Column) -> Column:
    """Numbers, from 0, of the sections of ``new`` whose digest ``old`` does not have."""
    had = F.transform(old, lambda s: s["digest"])
    marked = F.transform(
        new, lambda s, i: F.when(~F.array_contains(had, s["digest"]), i)
    )
    return F.filter(marked, lambda i: i.isNotNull())


def _neighbours(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """(doc_id, before, wanted): the id this one follows in descending order, and how many leading
    code points that one takes. Also whether an id has several rows.

    Ids are ranked by a range partitioning: the place in the partition, which the row number holds,
    plus the sizes of the partitions before. Only partition sizes are ever in one place.
    """
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    ids = (
        docs.filter(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(size).alias("n_chars"), F.count("*").alias("rows"))
    )
    placed = written(
        ids.repartitionByRange(F.desc("doc_id"))
        .sortWithinPartitions(F.desc("doc_id"))
        .withColumn("at", F.monotonically_increasing_id())
        .withColumns(
            {
                "part": F.shiftright("at", 33),
                "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1)),
            }
        ),
        "places",
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.max("rows").alias("most"))
    parts = sizes.orderBy("part").collect()
    total = sum(p["n"] for p in parts)
    offsets, before = [], 0
    for p in parts:
        offsets.append((p["part"], before))
        before += p["n"]
    starts = docs.sparkSession.createDataFrame(offsets, "part bigint, start bigint")
    ranked = placed.join(F.broadcast(starts), "part").select(
        "doc_id", "n_chars", (F.col("start") + F.col("place")).alias("rank")
    )
    above = ranked.select(
        F.col("doc_id").alias("before"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("wanted"),
        F.pmod(F.col("rank") + 1, F.lit(max(total, 1))).alias("rank"),
    )
    return ranked.join(above, "rank").select("doc_id", "before", "wanted"), any(
        p["most"] > 1 for p in parts
    )


def edit_likeness(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", without_id: bool = False
) -> DataFrame:
    """Every text against an edited copy and against the next document.

    The edited copy has its last half replaced by the start of the next document in descending order
    of ids; after the last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint and
    edited_fingerprint (roots), near_edited and near_next. ``changed_sections`` names the branches
    that differ.

    Texts meet by one join on ids: each row sends its first half and its leaves, and to the row
    before it the leading characters that one wants and its leaves.

    Null texts are empty; two empty trees have likeness 1. A single row is its own next document.
    Rows without an id have no neighbour: they are left out or, ``without_id``, have their n_chars and
    fingerprint, and null for all that the neighbour gives. Of several rows with one id each is
    compared, and the greatest of them stands as the next document. An empty table gives an empty
    result; other columns are not looked at.
    """
    near, repeated = _neighbours(docs, doc_id, text)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    rows = lookup_join(rows, near, "doc_id")
    n = F.length("text")
    own = rows.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.expr("substring(text, 1, CAST(length(text) - floor(length(text) / 2) AS INT))").alias("head"),
        root(F.col("text")).alias("fingerprint"),
        leaf_codes(F.col("text")).alias("codes"),
    )
    follower = rows.select(
        F.col("before").alias("doc_id"),
        F.expr("substring(text, 1, wanted)").alias("lead"),
        leaf_codes(F.col("text")).alias("next_codes"),
    )
    if repeated:
        follower = follower.groupBy("doc_id").agg(
            F.max(F.struct("lead", "next_codes")).alias("top")
        ).select("doc_id", "top.*")
    met = own.join(follower, "doc_id").withColumn("edited", F.concat("head", "lead"))
    compared = met.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        "fingerprint",
        root(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("codes"), leaf_codes(F.col("edited"))).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
    if not without_id:
        return compared
    known = {
        "doc_id": F.col(doc_id),
        "n_chars": F.length(body).cast("bigint"),
        "fingerprint": root(body),
    }
    lone = docs.filter(F.col(doc_id).isNull()).select(
        *[
            known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in compared.schema.fields
        ]
    )
    return compared.unionByName(lone)
