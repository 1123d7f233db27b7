"""Merkle manifest of a dataset: incremental witnesses over streamed, aligned appends."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallytide.llm.common import ascii_lower, written
from tallytide.operators.sizing import lookup_join

FANOUT = 8
#: Levels of a block: a task appends ``FANOUT ** LEVELS`` leaves to one subtree at most.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def field_text(column: Column) -> Column:
    """A value as a leaf spells it: ``-`` for null, else its length in bytes, a colon and itself."""
    value = column.cast("string")
    size = F.octet_length(value).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field_text, columns)), 256))


def node_digest(children: Sequence[bytes]) -> bytes:
    """A node: the digest of its children's digests, which are written as hexadecimal text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


class OpenTree:
    """A subtree that grows by appends from the left, with a partial witness for every leaf below.

    Each level holds one open run of nodes with the leaves under each. A run that is full becomes a
    node of the next level: every leaf under it then gets its siblings there, which extends its
    witness by one step. A witness is a string of steps; a step is the number of siblings to the left
    and to the right, one byte each, and their digests.
    """

    def __init__(self) -> None:
        self.runs: list[list[tuple[bytes, list[int]]]] = []
        self.witnesses: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.witnesses.append(bytearray())
        self._put(0, digest, [len(self.witnesses) - 1])

    def _put(self, level: int, digest: bytes, leaves: list[int]) -> None:
        if level == len(self.runs):
            self.runs.append([])
        run = self.runs[level]
        run.append((digest, leaves))
        if len(run) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [d for d, _ in run]
        for i, (_, leaves) in enumerate(run):
            step = bytes((i, len(run) - i - 1)) + b"".join(digests[:i] + digests[i + 1 :])
            for leaf in leaves:
                self.witnesses[leaf] += step
        self._put(level + 1, node_digest(digests), [x for _, leaves in run for x in leaves])

    def close(self, height: int) -> bytes:
        """Completes what is open, up to the level of the root, and returns that."""
        for level in range(height):
            if level < len(self.runs) and self.runs[level]:
                self._complete(level)
        return self.runs[height][0][0]


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // FANOUT), height + 1
    return height


def steps(witness: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(left, right) siblings of each level, from the leaf up."""
    at = 0
    while at < len(witness):
        left, right = witness[at : at + 2]
        at += 2
        found = [witness[at + DIGEST * i : at + DIGEST * (i + 1)] for i in range(left + right)]
        at += DIGEST * (left + right)
        yield found[:left], found[left:]


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    for left, right in steps(witness):
        leaf = node_digest([*left, leaf, *right])
    return leaf


def proof_digest(witness: bytes) -> bytes:
    """The digest of all siblings, level by level and from left to right."""
    return node_digest([d for left, right in steps(witness) for d in (*left, *right)])


def numbered(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``pos``, the gapless place from 0 in the row's tree, and ``size``, the rows of the tree.

    Rows are sorted by range once and written; places follow from the number of rows each range has of
    each tree, so no tree is gathered in one task. ``order`` should tell rows apart, so that a tree
    or a value with very many rows is cut into ranges as well.
    """
    keys = [tree, *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(ranged.withColumn("__seq", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("__range", F.shiftright("__seq", 33))
    counts = placed.groupBy(tree, "__range").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__seq").alias("__first")
    )
    whole = Window.partitionBy(tree)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        tree,
        "__range",
        "__n",
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("size"),
    )
    joined = lookup_join(placed, counts, [tree, "__range"], rows="__n")
    return joined.withColumn("pos", F.col("__seq") + F.col("__shift")).drop(
        "__seq", "__range", "__shift"
    )


def _append_blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Appends the ``digest`` of the nodes (tree, pos, size) to the subtree of their aligned block.

    Returns the nodes with ``block``, ``witness`` up to the block's root, and on the last node of a
    block ``block_root``. Rows stream through a task in order; it holds one open block. A tree of one
    block is as high as its leaves ask, one of several has blocks of ``LEVELS`` levels.
    """
    span = FANOUT**LEVELS
    rows = nodes.withColumn("block", F.floor(F.col("pos") / span))
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    fields = [*rows.schema.fields, T.StructField("witness", T.BinaryType())]
    schema = T.StructType([*fields, T.StructField("block_root", T.BinaryType())])

    def close(parts: list[pa.RecordBatch], open_tree: OpenTree) -> pa.Table:
        table = pa.Table.from_batches(parts)
        size = table.column("size")[0].as_py()
        root = open_tree.close(LEVELS if size > span else height_of(size))
        witnesses = pa.array(map(bytes, open_tree.witnesses), pa.binary())
        roots = pa.array([None] * (table.num_rows - 1) + [root], pa.binary())
        return table.append_column("witness", witnesses).append_column("block_root", roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, open_tree = None, [], OpenTree()
        for batch in batches:
            trees, blocks = batch.column("tree").to_pylist(), batch.column("block").to_pylist()
            digests = batch.column("digest").to_pylist()
            start = 0
            for i, here in enumerate(zip(trees, blocks, strict=True)):
                if here != at:
                    if i > start:
                        parts.append(batch.slice(start, i - start))
                    if parts:
                        yield from close(parts, open_tree).to_batches()
                    at, parts, open_tree, start = here, [], OpenTree(), i
                open_tree.append(digests[i])
            parts.append(batch.slice(start))
        if parts:
            yield from close(parts, open_tree).to_batches()

    return written(rows.mapInArrow(run, schema), name)


def _witnessed(nodes: DataFrame, name: str) -> DataFrame:
    """The nodes with ``witness`` up to the root of their tree, ``root`` of that tree.

    The roots of the blocks are the next appends: they are nodes of the same trees, and their own
    witnesses extend those of the leaves below.
    """
    tier = _append_blocks(nodes, name)
    roots = tier.filter("block_root IS NOT NULL")
    above = roots.select(
        "tree",
        F.col("block").alias("pos"),
        F.ceil(F.col("size") / FANOUT**LEVELS).alias("size"),
        F.col("block_root").alias("digest"),
    )
    if above.filter("size > 1").isEmpty():
        ends = above.select("tree", F.col("pos").alias("block"), F.col("digest").alias("root"))
        ends = ends.withColumn("more", F.lit(b""))
    else:
        ends = _witnessed(above, name).select(
            "tree", F.col("pos").alias("block"), "root", F.col("witness").alias("more")
        )
    sizes = roots.select("tree", "block", (F.col("pos") % FANOUT**LEVELS + 1).alias("__n"))
    ends = ends.join(sizes, ["tree", "block"])
    joined = lookup_join(tier.drop("block_root"), ends, ["tree", "block"], rows="__n")
    return joined.withColumn("witness", F.concat("witness", "more")).drop("more", "block")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree: str = "lang",
    order: str = "doc_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: ``order``, the columns of ``carry``, and as bytes ``leaf``, ``subroot``,
    ``root`` and ``witness``, with which ``fold`` leads from the leaf to the root.

    A row is a leaf: the digest of ``fields``. The leaves of each value of ``tree`` ascend by
    ``order`` and every ``FANOUT`` consecutive ones become a node until one is left, the subroot; the
    subroots, ordered by value, give the root in the same way. Rows are dealt into aligned blocks of
    ``FANOUT ** LEVELS`` leaves. A task appends them one by one to an open subtree; a leaf's witness
    grows as its siblings complete. Block roots, and then subroots, are appended likewise.

    Only the digests are shuffled. A null of ``tree`` is a tree of its own that comes first; null
    values of ``order`` come first too. Rows with one ``order`` ascend by their leaf, and rows that
    repeat one another are leaves each. Empty texts differ from nulls. An empty table gives an empty
    result; columns that are not named are not looked at.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    leaves = docs.select(
        F.col(order).alias("order"),
        key.alias("tree"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.struct(*[c.alias(n) for n, c in (carry or {"none": F.lit(0)}).items()]).alias("carried"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = numbered(leaves, "tree", ["order", "digest", "row"], "leaves").drop("row")
    rows = _witnessed(placed, "witnesses").withColumnRenamed("root", "subroot")
    subroots = rows.filter("pos = 0").select(
        F.lit("").alias("all"), F.col("tree").alias("name"), F.col("subroot").alias("digest"), "size"
    )
    subroots = numbered(
        subroots.withColumnRenamed("size", "n"), "all", ["name"], "subroots"
    ).withColumnRenamed("all", "tree")
    upper = _witnessed(subroots, "roots").select(
        F.col("name").alias("tree"), "root", F.col("witness").alias("more"), "n"
    )
    found = lookup_join(rows, upper, "tree", rows="n")
    return found.select(
        F.col("order").alias(order),
        *[F.col("carried").getField(c).alias(c) for c in carry or ()],
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.concat("witness", "more").alias("witness"),
    )


def folded(rows: DataFrame, claimed: str, out: str = "folded_root") -> DataFrame:
    """Adds the digest of each row's proof and the root that its claimed leaf folds to, as bytes."""
    fields = [T.StructField("proof", T.BinaryType()), T.StructField(out, T.BinaryType())]
    schema = T.StructType([*rows.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, roots = [], []
            pairs = zip(batch.column(claimed), batch.column("witness"), strict=True)
            for leaf, witness in pairs:
                known = witness.as_py()
                proofs.append(proof_digest(known))
                roots.append(fold(leaf.as_py(), known))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(proofs, pa.binary()), pa.array(roots, pa.binary())],
                [*batch.schema.names, "proof", out],
            )

    return rows.mapInArrow(run, schema)


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` with every row checked against the root, a third of them altered.

    Rows whose id's CRC-32 is divisible by 3 claim a text with A-Z in lower case; others, and rows
    without an id, claim their own. Digests are hexadecimal text. See ``manifest`` for odd input.
    """
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    claimed = F.when(altered, leaf_digest(lowered))
    rows = manifest(docs, carry={"claimed": claimed})
    rows = rows.withColumn("claimed", F.coalesce("claimed", "leaf"))
    found = folded(rows, "claimed")
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select(
        "doc_id",
        *hexed,
        F.lower(F.hex("proof")).alias("proof_sha256"),
        F.lower(F.hex("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
