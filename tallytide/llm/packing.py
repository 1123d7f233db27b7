"""Best-fit packing of token sequences, planned over a histogram of lengths."""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tallytide.llm.common import driver_table, written
from tallytide.llm.tokens import by_rank, load, rank_encoder

CAPACITY = 2048
END_ID = 0
RANKED_TOGETHER = 2000


class TextIds:
    """Whole texts to ids, packed as little-endian 32-bit numbers.

    A file that ``by_rank`` has proven is encoded by the rank table in one call a text; a text with a
    run of white space beyond the splitter's stack, and any other file, by the tokenizers library.
    """

    def __init__(self, path: str, ranked: bool):
        self.path = path
        self.ranks = rank_encoder(path) if ranked else None

    @cached_property
    def library(self) -> Tokenizer:
        return load(self.path)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def text(self, text: str) -> bytes:
        if self.ranks is None:
            return self.whole(text)
        try:
            ids = self.ranks.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return self.whole(text)
        return ids.astype("<u4", copy=False).tobytes()


def encode_pieces(batch: pa.RecordBatch, encoder: TextIds, capacity: int) -> dict[str, list]:
    """The pieces of a batch of (row, doc_id, text): longer documents are cut, the first piece may
    be shorter."""
    out: dict[str, list] = defaultdict(list)
    end = END_ID.to_bytes(4, "little")
    for i, text in enumerate(batch.column("text")):
        ids = encoder.text(text.as_py() or "") + end
        total = len(ids) // 4
        start, piece = 0, 0
        while start < total:
            size = (total - start) % capacity or capacity
            out["at"].append(i)
            out["piece"].append(piece)
            out["start"].append(start)
            out["length"].append(size)
            out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * (start + size)]))
            start, piece = start + size, piece + 1
    return out


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row) of every text with the end id appended."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ranked = by_rank(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextIds(tokenizer, ranked)
        for batch in batches:
            out = encode_pieces(batch, encoder, capacity)
            ids = batch.column("doc_id").take(pa.array(out["at"], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(out["piece"], pa.int32()),
                    *[pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    pieces = rows.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )
    return pieces.withColumn("row", F.monotonically_increasing_id())


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best-fit decreasing over a histogram of lengths.

    Sequences with the same room are kept as ranges of numbers, so the work depends on the number
    of lengths and not of pieces. Returns slots (length, first rank, end rank, first sequence,
    offset, pieces per sequence): rank r takes sequence ``first + (r - first rank) // per`` at
    ``offset + (r - first rank) % per * length``.
    """
    slots: list[tuple] = []
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    fresh = 0

    def put(room: int, first: int, n: int) -> None:
        if not n or not room:
            return
        if not ranges[room]:
            bisect.insort(rooms, room)
        heapq.heappush(ranges[room], (first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            first, n = heapq.heappop(ranges[room])
            if not ranges[room]:
                rooms.pop(at)
            used = min(n, left)
            slots.append((length, rank, rank + used, first, capacity - room, 1))
            put(room, first + used, n - used)
            put(room - length, first, used)
            left, rank = left - used, rank + used
        if left:
            per = capacity // length
            full, rest = divmod(left, per)
            slots.append((length, rank, rank + left, fresh, 0, per))
            put(capacity - per * length, fresh, full)
            put(capacity - rest * length, fresh + full, 1 if rest else 0)
            fresh += full + (1 if rest else 0)
    return slots


def _ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``rank``, gapless from 0 within each length, without gathering a length in one task.

    Pieces of a length are dealt into as many parts as keep each near ``RANKED_TOGETHER`` rows,
    numbered inside the part, and moved up by the sizes of the parts before.
    """
    spark = pieces.sparkSession
    parts = driver_table(
        spark,
        [(length, max(1, n // RANKED_TOGETHER)) for length, n in counts.items()],
        "length bigint, parts bigint",
    )
    dealt = pieces.join(F.broadcast(parts), "length").withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts"))
    )
    before = (
        dealt.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"),
        )
    )
    inside = Window.partitionBy("length", "part").orderBy("row")
    return (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(before.drop("n"), ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("before", "inside", "part", "parts")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The driver sees the histogram of lengths only: at most ``capacity`` counts, whatever the size of
    the corpus. It plans best-fit decreasing over them, and pieces take the planned slots by joining
    on their rank within the length; the slots are broadcast, and their number depends on the
    lengths alone.

    A null or empty text is the end id alone, a sequence entry of length 1. Texts of any length are
    encoded whole. Repeated rows and ids are packed one by one, null ids too. An empty table gives
    an empty result; other columns are not looked at.
    """
    pieces = written(token_pieces(docs, tokenizer, capacity, doc_id, text), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = driver_table(
        pieces.sparkSession,
        plan_best_fit(counts, capacity),
        "of_length bigint, low bigint, high bigint, first bigint, base bigint, per bigint",
    )
    ranked = _ranked(pieces, counts)
    step = F.col("rank") - F.col("low")
    return (
        ranked.join(
            F.broadcast(slots), F.expr("length = of_length AND rank >= low AND rank < high")
        ).select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first") + F.floor(step / F.col("per"))).alias("sequence_id"),
            (F.col("base") + step % F.col("per") * F.col("length")).alias("offset"),
        )
    )
