"""Near duplicates by SimHash: one-wildcard segment variants, equality join, verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import written
from tallytide.llm.components import connected_components
from tallytide.operators.sizing import lookup_join, split_join

BITS = 64
SEED = 42
BLOCK = 1 << 16
#: Orders by which a segment's bucket names its leaders: smallest and largest of the fingerprints
#: with these bits flipped.
FLIPS = (0, 0x5555555555555555, 0x3333333333333333)


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the word shingles of a text; a bit is set if over half the shingle hashes set it."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    spans = list(zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(spans), BLOCK):
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans[at : at + BLOCK]]
        grid = np.unpackbits(
            np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += grid.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of every row as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"]
            )

    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of as few segments as leave one with at most one differing bit."""
    if not 2 <= max_bits <= 32:
        raise ValueError("max_bits must lie between 2 and 32")
    n = max_bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _part(value: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(value, offset).bitwiseAND(F.lit((1 << width) - 1))


def wildcard_index(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Every row once per bit, with ``bit`` and the ``key`` its segment has without that bit."""
    choice, split = None, F.lit(0)
    for offset, width in segments(max_bits):
        here = F.col("bit") >= offset
        value = _part(F.col("fp"), offset, width)
        choice = value if choice is None else F.when(here, value).otherwise(choice)
        split = F.when(here, F.lit(offset)).otherwise(split)
    rows = nodes.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))))
    rows = rows.withColumns({"seg": choice, "at": F.col("bit") - split})
    key = F.expr(
        "shiftleft(shiftright(seg, at + 1), at) + (seg & (shiftleft(1L, at) - 1)) "
        "+ shiftleft(CAST(bit AS BIGINT), 48)"
    )
    return rows.withColumn("key", key).drop("seg", "at")


def _first_match(diff: Column, max_bits: int) -> Column:
    """The one bit under which a pair counts: in its first segment with at most one difference."""
    cases = F.lit(None).cast("int")
    for offset, width in reversed(segments(max_bits)):
        part = _part(diff, offset, width)
        place = F.when(part == 0, F.lit(offset)).otherwise(F.bit_count(part - 1) + offset)
        cases = F.when(F.bit_count(part) <= 1, place).otherwise(cases)
    return cases


def _differing(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _leader_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Verified links to a few leaders of each whole-segment bucket.

    They thin out dense groups before pairs are looked for: what a leader already connects needs no
    pair of its own. Links missed here are found by the wildcard join. A bucket with very many
    fingerprints is spread over several tasks.
    """
    parts = segments(max_bits)
    keys = F.array(
        *[_part(F.col("fp"), o, w) + F.lit(i << 48) for i, (o, w) in enumerate(parts)]
    )
    index = nodes.select("fp", F.explode(keys).alias("key"))
    turned = [F.col("fp").bitwiseXOR(F.lit(flip)) for flip in FLIPS]
    leaders = index.groupBy("key").agg(
        F.array(
            *[
                pick(t).bitwiseXOR(F.lit(flip))
                for t, flip in zip(turned, FLIPS, strict=True)
                for pick in (F.min, F.max)
            ]
        ).alias("leaders"),
        F.count("*").alias("n"),
    )
    leaders = written(leaders.filter("n > 1"), "leaders")
    met = split_join(index, leaders.drop("n"), "key", weights=leaders.select("key", "n"), rows="n")
    links = met.select("fp", F.explode("leaders").alias("leader"))
    near = (F.col("fp") != F.col("leader")) & (F.bit_count(_differing("fp", "leader")) <= max_bits)
    return links.filter(near).select(F.col("fp").alias("u"), F.col("leader").alias("v"))


def _wildcard_links(grouped: DataFrame, max_bits: int) -> DataFrame:
    """Links between different groups: all pairs of fingerprints within ``max_bits``, each once."""
    index = wildcard_index(grouped, max_bits)
    left = index.select("key", "bit", F.col("fp").alias("fp_a"), F.col("root").alias("u"))
    right = index.select(
        F.col("key").alias("key_b"), F.col("bit").alias("bit_b"), F.col("fp").alias("fp_b"), F.col("root").alias("v")
    )
    diff = _differing("fp_a", "fp_b")
    match = (
        (F.col("key") == F.col("key_b"))
        & (F.col("u") < F.col("v"))
        & (F.bit_count(diff) <= max_bits)
        & (F.col("bit") == _first_match(diff, max_bits))
    )
    return left.join(right.hint("merge"), match).select("u", "v").distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    max_bits: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest id it reaches).

    Fingerprints link when they differ in at most ``max_bits`` bits. Cut into ``max_bits // 2 + 1``
    segments, two such fingerprints have a segment with at most one difference, so they share the
    key of that segment without the differing bit. Work is done on distinct fingerprints, so exact
    copies cost nothing; links to bucket leaders join dense groups first, and the wildcard join then
    emits only verified pairs from different groups, each once.

    Texts without words (null, empty, white space) have fingerprint zero, linked like any other.
    Null ids have a fingerprint but never name a component unless all its rows lack one. Repeated
    rows stay repeated. Columns beside id and text are not looked at.
    """
    rows = written(fingerprints(docs, words, doc_id, text), "fingerprints")
    nodes = written(
        rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")),
        "nodes",
    )
    first = written(connected_components(_leader_links(nodes, max_bits)), "groups")
    grouped = written(
        lookup_join(nodes, first.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp")
        ),
        "grouped",
    )
    links = _wildcard_links(grouped.select("fp", "root"), max_bits)
    joined = connected_components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))
    grouped = lookup_join(grouped, joined, "root", "left").withColumn(
        "root", F.coalesce("top", "root")
    )
    grouped = written(grouped.drop("top"), "joined")
    least = grouped.groupBy("root").agg(
        F.min("least").alias("component_id"),
        F.sum("copies").alias("docs"),
        F.count("*").alias("n"),
    )
    named = lookup_join(grouped, least.filter("docs > 1"), "root", rows="n")
    named = named.select("fp", "component_id", F.col("copies").alias("n"))
    return lookup_join(rows, named, "fp", "left", rows="n").select(
        "doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame,
    words: int = 4,
    max_bits: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows whose id is the smallest of their group, with all their columns.

    Expects ids that name one row each, as exact deduplication leaves them; rows without an id stay.
    """
    found = near_duplicates(docs, words, max_bits, doc_id, text)
    lost = found.filter("doc_id != component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return lookup_join(docs, lost, doc_id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
