"""N-gram Jaccard self-join by signature trees: dual traversal over OR-combined token bitmaps."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import written
from tallytide.llm.components import connected_components
from tallytide.llm.manifest import numbered
from tallytide.operators.sizing import lookup_join, settle

#: Bits of a signature in the trees.
BITS = 1024
#: Members of a leaf block, which one task traverses with itself or with another block, and of the
#: nodes inside a block.
BLOCK = 256
NODE = 16
#: Nodes above the blocks have so many children.
FANOUT = 8
#: Leaders, and rows of about its size, that a row is compared with before the trees.
LED = 2
FOLLOWED = 12
#: Documents of the sample that tells frequent shingles from rare ones, and shingles kept of it.
SAMPLED_DOCS = 10_000
FREQUENT = 50_000
#: Sides up to this size are broadcast; most sides here grow with the corpus.
BROADCAST_BYTES = 16 * 1024 * 1024
#: Number of others of a row that a batch alone does not tell.
UNKNOWN = 1 << 32
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]

_join = partial(lookup_join, limit_bytes=BROADCAST_BYTES)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * MIX[1]
    value = (value ^ (value >> np.uint64(27))) * MIX[2]
    return value ^ (value >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    width = min(words, len(tokens))
    known: dict[bytes, int] = {}
    for token in tokens:
        if token not in known:
            known[token] = xxhash.xxh64_intdigest(token)
    codes = np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))
    last = len(tokens) - width + 1
    found = np.full(last, np.uint64(width), np.uint64)
    for i in range(width):
        found = _mixed(found * MIX[0] + codes[i : i + last])
    return np.unique(found)


def signature(shingles: np.ndarray) -> np.ndarray:
    """A bitmap with a bit per shingle, which several may share: ``BITS`` bits, or the power of two
    that is twice their number or more."""
    size = max(BITS, 1 << (2 * len(shingles)).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(shingles % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def cut(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap as it would be with fewer bits."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bound(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> int:
    """The largest overlap that the bitmaps of two sets leave open: a bit that only one of them has is
    a shingle that they do not share."""
    words = min(len(a), len(b))
    a, b = cut(a, words), cut(b, words)
    return min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))


def prefix(shingles: np.ndarray, percent: int, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles in the order of rising frequency, as many as make two sets that are similar
    enough share one: sets without a common one overlap too little."""
    n = len(shingles)
    known, weights = common
    rank = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        rank = np.where(known[at] == shingles, weights[at], 0)
    return shingles[np.lexsort((shingles, rank))][: n - -(-percent * n // 100) + 1]


def short_prefix(n: int, percent: int) -> int:
    """How much of the prefix of the smaller of two sets is enough to meet the larger one's."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _frequent(docs: DataFrame, words: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that recur in a sample of ``SAMPLED_DOCS`` texts, sorted, and their counts there.

    They order the shingles of a set; any order gives the same links, this one small groups.
    """
    share = min(1.0, SAMPLED_DOCS / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.lit(7), F.col(text)), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = docs.filter(drawn | F.lit(share == 1.0)).select(F.col(text).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                found = shingle_set(value.as_py(), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["shingle"])

    counts = sample.mapInArrow(run, "shingle bigint").groupBy("shingle").count().filter("count > 2")
    top = counts.orderBy(F.desc("count"), "shingle").limit(FREQUENT).toPandas()
    known = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], top["count"].to_numpy(np.int64)[order]


def _signatures(docs: DataFrame, words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, row, cls, n, prefix, bits) of every row: ``cls`` names its set, ``key`` its text."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_frequent(docs, words, text))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.md5(body)).alias("key"), body.alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"cls": [], "n": [], "prefix": [], "bits": []}
            for value in batch.column("text"):
                found = shingle_set(value.as_py(), words)
                out["cls"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                out["n"].append(len(found))
                out["prefix"].append(prefix(found, percent, common.value).view(np.int64))
                out["bits"].append(signature(found).tobytes())
            kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            arrays = [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *arrays], ["doc_id", "key", *out]
            )

    schema = f"doc_id {kind}, key binary, cls binary, n bigint, prefix array<bigint>, bits binary"
    found = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    return written(found, "signatures")


class Nodes:
    """Nodes of a signature tree: bitmap, sizes, largest number of shingles that share a bit with
    another of their set, and groups."""

    def __init__(self, bits, low, high, excess, first, last):
        self.bits, self.low, self.high, self.excess = bits, low, high, excess
        self.first, self.last = first, last

    @classmethod
    def of(cls, rows: pa.Table) -> Nodes:
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64)
        names = ("low", "high", "excess", "first", "last")
        return cls(bits.reshape(rows.num_rows, -1), *(rows.column(c).to_numpy() for c in names))

    def grouped(self, starts: np.ndarray) -> Nodes:
        """The runs of nodes that start at these places as one node each."""
        return Nodes(
            np.bitwise_or.reduceat(self.bits, starts),
            np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts),
            np.maximum.reduceat(self.excess, starts),
            np.minimum.reduceat(self.first, starts),
            np.maximum.reduceat(self.last, starts),
        )

    def take(self, at: np.ndarray) -> Nodes:
        return Nodes(*(v[at] for v in vars(self).values()))


def may_link(a: Nodes, b: Nodes, percent: int) -> np.ndarray:
    """Whether sets below two nodes may overlap enough and belong to different groups.

    A bit of one set that the other node lacks is a shingle that is not shared, so the overlap of two
    sets is at most the bits that both nodes have and the shingles that share a bit.
    """
    both = np.bitwise_count(a.bits & b.bits).sum(axis=1, dtype=np.int64)
    most = np.minimum(both + np.minimum(a.excess, b.excess), np.minimum(a.high, b.high))
    enough = most * (100 + percent) >= percent * (a.low + b.low)
    one = (a.first == a.last) & (b.first == b.last) & (a.first == b.first)
    return enough & ~one


def _expand(left: np.ndarray, right: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of children of pairs of inner nodes."""
    step = np.arange(NODE)
    i = (left[:, None, None] * NODE + step[None, :, None]) + 0 * step[None, None, :]
    j = (right[:, None, None] * NODE + step[None, None, :]) + 0 * step[None, :, None]
    i, j = i.ravel(), j.ravel()
    inside = (i < sizes[0]) & (j < sizes[1])
    return i[inside], j[inside]


def traverse(a: Nodes, b: Nodes | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of one block, or of two, whose sets may link: down both trees at once."""
    other = a if b is None else b
    upper, lower = (n.grouped(np.arange(0, len(n.low), NODE)) for n in (a, other))
    i, j = (m.ravel() for m in np.indices((len(upper.low), len(lower.low))))
    if b is None:
        i, j = i[i <= j], j[i <= j]
    kept = may_link(upper.take(i), lower.take(j), percent)
    i, j = _expand(i[kept], j[kept], (len(a.low), len(other.low)))
    if b is None:
        i, j = i[i < j], j[i < j]
    kept = may_link(a.take(i), other.take(j), percent)
    return i[kept], j[kept]


def _neighbours(starts: np.ndarray, ends: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places inside the runs that are ``few``, which have ``NODE`` rows at most."""
    run = np.repeat(np.where(few, np.arange(len(starts)), -1), ends - starts)
    found = []
    for step in range(1, NODE):
        i = np.flatnonzero((run[:-step] == run[step:]) & (run[:-step] >= 0))
        found.append((i, i + step))
    return tuple(np.concatenate([pair[k] for pair in found]) for k in (0, 1))


Work = Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table]


def _streamed(keys: list[str], work: Work) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Applies ``work`` to whole runs of rows with equal keys (a table, starts, ends), of sorted rows.

    The last run of a batch waits for the next one, so a task holds a batch and one run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            starts = _starts(table)
            held = table.slice(starts[-1]).combine_chunks()
            if len(starts) > 1:
                done = table.slice(0, starts[-1])
                yield from work(done, starts[:-1], starts[1:]).to_batches()
        if held is not None:
            yield from work(held, np.array([0]), np.array([held.num_rows])).to_batches()

    def _starts(table: pa.Table) -> np.ndarray:
        values = [table.column(k).to_numpy() for k in keys]
        turn = np.any([v[1:] != v[:-1] for v in values], axis=0)
        return np.concatenate(([0], np.flatnonzero(turn) + 1))

    return run


NODE_COLUMNS = "bits binary, low bigint, high bigint, excess bigint, first bigint, last bigint"


def _linked(percent: int) -> Callable[[str, str], Column]:
    """``may_link`` on two columns of nodes."""

    @F.pandas_udf("boolean")
    def linked(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        one, two = (Nodes.of(pa.Table.from_pandas(x, preserve_index=False)) for x in (a, b))
        return pd.Series(may_link(one, two, percent))

    return linked


def _upper(nodes: DataFrame, parent: str) -> DataFrame:
    """One level up: ``nodes`` (token, at, ...) combined by (token, ``parent``)."""
    rows = nodes.withColumn("up", F.expr(parent)).repartition("token", "up")

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
        node = Nodes.of(rows).grouped(starts)
        named = {k: pa.array(v) for k, v in vars(node).items() if k != "bits"}
        keys = {"token": rows.column("token").take(starts), "at": rows.column("up").take(starts)}
        bits = pa.array([b.tobytes() for b in node.bits], pa.binary())
        return pa.table({"bits": bits, **named, **keys})

    found = rows.sortWithinPartitions("token", "up").mapInArrow(
        _streamed(["token", "up"], work), f"{NODE_COLUMNS}, token bigint, at bigint"
    )
    return written(found, "nodes")


def _block_pairs(wide: DataFrame, percent: int) -> DataFrame:
    """(token, a, b) with a < b: blocks of one shingle that may hold linked sets of different groups.

    Dual traversal from the root of each shingle's tree, one level a round: a pair of nodes that may
    link gives way to the pairs of their children.
    """
    levels = [_upper(wide.select("*", F.col("block").alias("at")), "block")]
    while not levels[-1].filter("at > 0").isEmpty():
        levels.append(_upper(levels[-1], f"at DIV {FANOUT}"))
    pairs = levels[-1].selectExpr("token", "at AS a", "at AS b")

    names = [c.split()[0] for c in NODE_COLUMNS.split(", ")]
    linked = _linked(percent)
    for level in reversed(levels[:-1]):
        kids = level.withColumn("up", F.expr(f"at DIV {FANOUT}"))
        sides = [
            kids.select("token", F.col("up").alias(s), F.col("at").alias(f"{s}_at"), F.struct(*names).alias(f"{s}_node"))
            for s in "ab"
        ]
        met = pairs.join(sides[0], ["token", "a"]).join(sides[1], ["token", "b"]).filter("a_at <= b_at")
        met = met.filter(linked("a_node", "b_node"))
        pairs = written(met.selectExpr("token", "a_at AS a", "b_at AS b"), "pairs")
    return pairs.filter("a < b")


def _candidates(members: DataFrame, leaves: DataFrame, percent: int) -> DataFrame:
    """(u, v): rows whose sets may link, of different groups, by the trees of all shared shingles.

    ``members`` has (token, row, at, first, last, pos, size); a shingle's rows are dealt into blocks
    in the order of ``pos``. ``leaves`` has their bitmaps and sizes. A pair is looked for at the first
    shingle that both sets have: there the shingles before ``at`` are none that they share, so what
    is left of the set bounds the overlap.
    """
    side = settle(leaves)
    columns = ["token", "a", "b", "side", "pos", "row", "bits", "low", "high", "excess", "first", "last"]

    def with_leaves(rows: DataFrame) -> DataFrame:
        rows = _join(rows, side, "row").withColumn("block", F.expr(f"pos DIV {BLOCK}"))
        return rows.withColumn("high", F.col("low") - F.col("at")).drop("at")

    rows = with_leaves(members).selectExpr("*", "block AS a", "block AS b", "0 AS side").select(columns)
    large = members.filter(F.col("size") > BLOCK)
    if not large.isEmpty():
        wide = with_leaves(large)
        pairs = _block_pairs(wide, percent)
        sides = [
            wide.join(pairs.withColumn("block", F.col(s)), ["token", "block"])
            .withColumn("side", F.lit(i))
            .select(columns)
            for i, s in enumerate("ab")
        ]
        rows = rows.unionByName(sides[0]).unionByName(sides[1])
    rows = rows.repartition("token", "a", "b").sortWithinPartitions("token", "a", "b", "side", "pos")

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
        nodes, side = Nodes.of(rows), rows.column("side").to_numpy()
        own = rows.column("a").to_numpy()[starts] == rows.column("b").to_numpy()[starts]
        few = own & (ends - starts <= NODE)
        i, j = _neighbours(starts, ends, few)
        kept = may_link(nodes.take(i), nodes.take(j), percent)
        found = [(i[kept], j[kept])]
        for at, end in zip(starts[~few], ends[~few], strict=True):
            cut = at + int((side[at:end] == 0).sum())
            left, right = np.arange(at, cut), np.arange(cut, end)
            other = nodes.take(right) if len(right) else None
            i, j = traverse(nodes.take(left), other, percent)
            found.append((left[i], (right if len(right) else left)[j]))
        row = rows.column("row").to_numpy()
        u, v = (row[np.concatenate([pair[k] for pair in found])] for k in (0, 1))
        links = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        return pa.table({"u": links[0], "v": links[1]})

    found = rows.mapInArrow(_streamed(["token", "a", "b"], work), "u bigint, v bigint")
    return found.distinct()


def _verified(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int, text: str
) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sets overlap enough, compared whole.

    Only sets that stand in a pair are made again from their texts.
    """
    pairs = written(pairs, "candidates")
    asked = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row")))
    keys = _join(sets.select("row", "key"), asked.distinct(), "row", "left_semi")
    keys = written(keys, "keys")
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.unhex(F.md5(body)).alias("key"), body.alias("text"))
    texts = _join(texts, keys.select("key").distinct(), "key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.binary())], ["key", "shingles"]
            )

    made = texts.dropDuplicates(["key"]).mapInArrow(run, "key binary, shingles binary")
    made = written(keys.join(made, "key").drop("key"), "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    sides = [
        made.select(F.col("row").alias(r), F.col("shingles").alias(s)) for r, s in (("u", "x"), ("v", "y"))
    ]
    met = pairs.join(sides[0], "u").join(sides[1], "v")
    return written(met.mapInArrow(compare, "v bigint, u bigint").select("u", "v"), "links")


def _with_excess(sets: DataFrame) -> DataFrame:
    """Leaves of a signature tree from (row, n, bits), with the whole bitmap as ``fine``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [np.frombuffer(b, np.uint64) for b in batch.column("bits").to_pylist()]
            bits = [cut(b, BITS // 64) for b in whole]
            used = np.array([np.bitwise_count(b).sum() for b in bits], np.int64)
            n = batch.column("n")
            excess = pa.array(n.to_numpy(zero_copy_only=False) - used, pa.int64())
            coarse = pa.array([b.tobytes() for b in bits], pa.binary())
            columns = [batch.column("row"), coarse, n, n, excess, batch.column("bits")]
            names = ["row", "bits", "low", "high", "excess", "fine"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "row bigint, bits binary, low bigint, high bigint, excess bigint, fine binary"
    return sets.mapInArrow(run, kinds)


def _finer(pairs: DataFrame, leaves: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose whole bitmaps leave a link open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, n, y, m in zip(*(batch.column(c) for c in ("x", "n", "y", "m")), strict=True):
                a, b = (np.frombuffer(bits.as_py(), np.uint64) for bits in (x, y))
                sizes = n.as_py(), m.as_py()
                most = overlap_bound(a, sizes[0], b, sizes[1])
                kept.append(most * (100 + percent) >= percent * sum(sizes))
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    u = leaves.select(F.col("row").alias("u"), F.col("fine").alias("x"), F.col("low").alias("n"))
    v = leaves.select(F.col("row").alias("v"), F.col("fine").alias("y"), F.col("low").alias("m"))
    met = pairs.join(u, "u").join(v, "v").select("u", "v", "x", "n", "y", "m")
    return met.mapInArrow(run, "u bigint, v bigint")


def may_overlap(n: np.ndarray, at: np.ndarray, m: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles may overlap enough if the first one that they share stands
    at places ``at`` and ``place`` of them: those before it are none that they share."""
    return np.minimum(n - at, m - place) * (100 + percent) >= percent * (n + m)


def _matched(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (token, n, row, at) with the number of other sets that have the shingle and may link with
    theirs by size; rows without one are dropped.

    Rows come sorted by shingle and size. Those of the first and the last shingle of a batch stay, with
    ``UNKNOWN``: some of their others may be in the next batch or partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            token, n, at = (batch.column(c).to_numpy() for c in ("token", "n", "at"))
            turn = np.concatenate(([False], token[1:] != token[:-1])).cumsum()
            by_size = turn * (1 << 32) + n
            low = -(-percent * n // 100)
            high = np.minimum((n - at) * (100 + percent) // percent - n, 100 * n // percent)
            others = np.searchsorted(by_size, turn * (1 << 32) + high, "right")
            others -= np.searchsorted(by_size, turn * (1 << 32) + low, "left")
            others -= (low <= n) & (n <= high)
            others[(turn == 0) | (turn == turn[-1])] = UNKNOWN
            found = batch.append_column("others", pa.array(others, pa.int64()))
            yield found.filter(pa.array(others > 0))

    return run


def _shared(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, row, n, at, classes): the prefixes of the classes, for shingles that two of them share and
    one of them has in its short prefix; ``at`` is the place of the shingle in the prefix, ``classes`` are
    those of the shingle that may link with the row by size, itself included.

    Prefixes are sorted by range once, so a shingle of very many classes spreads, and only rows that
    another of their shingle may link with by size and place are counted and joined.
    """
    n = F.col("n")
    posted = nodes.select("n", "row", F.posexplode("prefix").alias("at", "token"))
    order = ["token", "n", "row"]
    ranged = posted.select(*order, "at").repartitionByRange(*order).sortWithinPartitions(*order)
    posted = ranged.mapInArrow(_matched(percent), "token bigint, n bigint, row bigint, at int, others bigint")
    posted = written(posted, "posted")
    short = n - F.ceil(2 * percent * n / (100 + percent)) + 1
    counts = posted.groupBy("token").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.col("at") <= short).alias("near")
    )
    counts = counts.filter("classes > 1 AND near").select("token", "classes", F.col("classes").alias("n_rows"))
    found = _join(posted, counts, "token", rows="n_rows")
    classes = F.least("classes", F.col("others") + 1).alias("classes")
    return written(found.select("token", "row", "n", "at", classes), "shared")


def _followers(rows: DataFrame, percent: int) -> DataFrame:
    """(row, other): a row and those of the ``FOLLOWED`` before it among those of a shingle, in the order of
    size, that it may link with by size and place of the shingle.

    Rows are sorted by range, so a shingle of very many rows spreads; only the first of a range have
    fewer before them.
    """
    order = ["token", "n", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)
        for batch in batches:
            seen = np.stack([batch.column(c).to_numpy() for c in ("token", "row", "n", "at")])
            seen = np.concatenate([held, seen], axis=1)
            found = []
            for step in range(1, FOLLOWED + 1):
                at = np.arange(max(step, held.shape[1]), seen.shape[1])
                at = at[seen[0, at] == seen[0, at - step]]
                at = at[may_overlap(*seen[2:, at], *seen[2:, at - step], percent)]
                found.append(seen[1, [at, at - step]])
            held = seen[:, -FOLLOWED:]
            pairs = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["row", "other"])

    ranged = rows.select(*order, "at").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "row bigint, other bigint")


def _leaders(shared: DataFrame, percent: int = 90) -> DataFrame:
    """(u, v): every row with the rows of each of its shingles that share most and least with others,
    and with those of the next smaller sizes, for shingles of more classes that may link with it than a
    node holds.

    A text that many near copies were made from has no shingle of its own, so it shares most. Near
    copies without such a leader among them are of about one size, and many of them link with each
    other. A shingle suggests only rows that may link by size and its places. A row is paired with the
    ``LED`` leaders and the ``FOLLOWED`` others that most of its shingles suggest, so pairs are as many
    as rows.
    """
    weights = shared.groupBy("row").agg(F.sum("classes").alias("weight"), F.count(F.lit(1)).alias("n_rows"))
    large = shared.filter(F.col("classes") > NODE).select("token", "row", "n", "at")
    weighed = written(_join(large, weights, "row", rows="n_rows"), "weighed")
    order = F.struct("weight", "row", "n", "at")
    ends = weighed.groupBy("token").agg(
        F.max(order).alias("most"), F.min(order).alias("least"), F.count(F.lit(1)).alias("n_rows")
    )
    kept = [(s, c) for s in ("most", "least") for c in ("row", "n", "at")]
    ends = ends.select("token", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s, c in kept), "n_rows")
    met = _join(weighed.select("token", "row", "n", "at"), ends, "token", rows="n_rows")
    both = [F.struct(*(F.col(f"{s}_{c}").alias(c) for k, c in kept if k == s)) for s in ("most", "least")]
    met = met.select("row", "n", "at", F.explode(F.array(*both)).alias("end"))
    enough = F.expr(f"least(n - at, end.n - end.at) * {100 + percent} >= {percent} * (n + end.n)")
    met = met.filter(enough).select("row", F.col("end.row").alias("other"), F.lit(0).alias("kind"))
    followers = _followers(weighed, percent).withColumn("kind", F.lit(1))
    met = met.unionByName(followers).filter("row != other")
    votes = met.groupBy("row", "kind", "other").agg((-F.count(F.lit(1))).alias("votes"))
    ranked = F.sort_array(F.collect_list(F.struct("votes", "other")))
    most = F.when(F.col("kind") == 0, LED).otherwise(FOLLOWED)
    chosen = votes.groupBy("row", "kind").agg(ranked.alias("ranked"))
    chosen = chosen.withColumn("chosen", F.slice("ranked", F.lit(1), most))
    pairs = chosen.select("row", F.explode("chosen.other").alias("other")).select(
        F.least("row", "other").alias("u"), F.greatest("row", "other").alias("v")
    )
    return pairs.distinct()


def _bounded(pairs: DataFrame, leaves: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures and sizes leave a link open."""
    names = [c.split()[0] for c in NODE_COLUMNS.split(", ")]

    linked = _linked(percent)
    own = leaves.withColumns({"first": F.col("row"), "last": F.col("row")})
    u = own.select(F.col("row").alias("u"), F.struct(*names).alias("x"))
    v = own.select(F.col("row").alias("v"), F.struct(*names).alias("y"))
    return pairs.join(u, "u").join(v, "v").filter(linked("x", "y")).select("u", "v")


def similar_components(
    docs: DataFrame,
    words: int = 3,
    percent: int = 90,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id it reaches).

    Rows link when the Jaccard similarity of their sets of distinct word shingles is ``percent`` or
    more. Rows with one set are one class, and all work is on classes. Two that link share one of
    the first shingles of both sets in the order of rising frequency. The classes of each such shingle
    are the leaves of a signature tree; nodes hold the OR of their bitmaps and ranges of sizes, and
    a traversal from a root down both sides drops pairs of nodes whose greatest possible overlap is
    too small. What remains is compared by the whole sets, as 64-bit hashes of the shingles.

    Before that, classes are compared with the leaders of their shingles. Nodes whose classes are
    already in one component are dropped too, so a large group of near copies does not meet itself
    pair by pair. A shingle with many classes is cut into blocks of ``BLOCK``, and pairs of blocks
    are work of their own.

    Null and empty texts, and texts without words, have no shingle and link with nothing; texts of
    fewer words than a shingle are one shingle. Null ids are never the smallest unless all of a
    component lack one. Repeated rows stay repeated. An empty table gives an empty result; columns
    beside id and text are not looked at.
    """
    sets = _signatures(docs, words, percent, doc_id, text)
    classes = written(
        sets.filter("n > 0").groupBy("cls").agg(
            F.min("row").alias("first"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    copied = classes.filter("copies > 1").select("cls", "first", "copies")
    lost = _join(sets.select("cls", "row"), copied, "cls", rows="copies").filter("row != first")
    nodes = _join(sets.filter("n > 0"), lost.select("row"), "row", "left_anti")
    shared = _shared(nodes, percent)
    used = _join(sets.select("row", "n", "bits"), shared.select("row").distinct(), "row", "left_semi")
    leaves = written(_with_excess(used), "leaves")
    coarse = leaves.drop("fine")
    pairs = _finer(_bounded(_leaders(shared, percent), coarse, percent), leaves, percent)
    first = _verified(pairs, sets, docs, words, percent, text)
    groups = written(connected_components(first), "groups")
    grouped = _join(leaves.select("row", "low"), groups.withColumnRenamed("node", "row"), "row", "left")
    grouped = grouped.withColumn("grp", F.coalesce("root", "row")).drop("root")
    lows = grouped.groupBy("grp").agg(F.min("low").alias("base"), F.count(F.lit(1)).alias("n_rows"))
    grouped = _join(grouped, lows, "grp", rows="n_rows")
    members = written(_join(shared.select("token", "row", "at"), grouped, "row"), "members")
    apart = members.groupBy("token").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("grp").alias("least"), F.max("grp").alias("most")
    )
    apart = apart.filter("least != most").select("token", "n_rows")
    members = _join(members, apart, "token", rows="n_rows")
    placed = numbered(members, "token", ["base", "grp", "low", "row"], "placed").select(
        "token", "row", "at", F.col("grp").alias("first"), F.col("grp").alias("last"), "pos", "size"
    )
    placed = written(placed, "members")
    pairs = _finer(_candidates(placed, coarse, percent), leaves, percent)
    second = _verified(pairs, sets, docs, words, percent, text)
    roots = connected_components(first.unionByName(second)).select(
        F.col("node").alias("first"), "root"
    )
    named = _join(classes, roots, "first", "left").withColumn("root", F.coalesce("root", "first"))
    named = written(named, "named")
    least = named.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_rows"), F.sum("copies").alias("rows")
    )
    named = _join(named, least.filter("rows > 1").drop("rows"), "root", rows="n_rows")
    named = named.select("cls", "component_id", F.col("copies").alias("n_rows"))
    return _join(sets.select("doc_id", "cls", "n"), named, "cls", "left", rows="n_rows").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
