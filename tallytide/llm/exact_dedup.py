"""Exact duplicates by digest, with the most frequent digests settled on the map side."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallytide.llm.common import ascii_lower, written
from tallytide.operators.sizing import lookup_join

MAX_FREQUENT = 1000
TRACKED = 10_000


class Digests(NamedTuple):
    """``rows``: id, row number and digest of every row; ``frequent``: at most MAX_FREQUENT groups."""

    rows: DataFrame
    frequent: DataFrame


def text_digest(text: str) -> F.Column:
    return F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256)


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Digests:
    """Digests of all texts and the verified groups of the frequent ones.

    A frequent-items sketch of the Misra-Gries kind (``approx_top_k``) runs inside the map tasks and
    is merged; it tracks ``TRACKED`` digests, so every digest with more than about one row in
    ``TRACKED`` is among them. Its estimates are only candidates: their counts and winners are then
    counted exactly.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("text_sha256"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    candidates = rows.agg(
        F.expr(f"approx_top_k(text_sha256, {MAX_FREQUENT}, {TRACKED})").alias("top")
    ).select(F.explode("top.item").alias("text_sha256"))
    frequent = (
        rows.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max(F.struct("doc_id", "row")).alias("winner"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    return Digests(rows, written(frequent, "frequent"))


def _judged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        F.struct("doc_id", "row").eqNullSafe(F.col("winner")).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the row with the largest id stays. Rows of
    frequent digests meet their winner by a broadcast of at most ``MAX_FREQUENT`` rows and are not
    shuffled; the groups that are left hold at most about one row in ``MAX_FREQUENT`` each and are
    shuffled once as (id, digest).

    Null and empty texts are one group. A null id is below all others. Of rows that repeat id and
    text exactly one is kept. An empty table gives an empty result; other columns are not looked at.
    """
    return _duplicates(digest_rows(docs, doc_id, text))


def _duplicates(digests: Digests) -> DataFrame:
    marked = digests.rows.join(F.broadcast(digests.frequent), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    rest = (
        marked.filter("group_size IS NULL")
        .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return _judged(marked.filter("group_size IS NOT NULL")).unionByName(_judged(rest))


def _id_text(doc_id: str) -> F.Column:
    """An id as text that no null id shares."""
    return F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit(""))


def drop_exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losers are taken out by an anti join on (id, digest): a broadcast when they measure small, so
    that texts are not shuffled, else a shuffle join. Rows that repeat a kept id and text collapse
    to one.
    """
    judged = written(_duplicates(digest_rows(docs, doc_id, text)), "judged")
    loser = ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    key = ["__id", "__digest"]
    lost = judged.filter(loser).select(
        _id_text("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")
    )
    named = docs.withColumns({"__id": _id_text(doc_id), "__digest": text_digest(text)})
    kept = lookup_join(named, lost.distinct(), key, "left_anti")
    if not judged.filter(~loser & ~F.col("kept")).isEmpty():
        kept = kept.dropDuplicates(key)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
