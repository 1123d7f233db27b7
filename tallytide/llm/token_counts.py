"""Token counts per document from piece counts per distinct pre-token."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.llm.common import unit_hash
from tallytide.llm.tokens import LATIN, PLAIN_WORD, load

SAMPLE_DOCS = 20_000
COMMON = 200_000
CACHED = 500_000
ROWS_AT_ONCE = 100_000
#: White space at which every tokenizer with a white-space rule splits.
CHUNK = re.compile(r"[^ \t\n\r\f\v]+")


class Chunks(dict):
    """For each chunk between white space: pieces of its common pre-tokens, and the other pre-tokens.

    Pre-tokens come from the tokenizer's own normalizer and pre-tokenizer. White space always
    separates them in this family, so chunks can be taken one by one. Added tokens are found before
    normalizing, as the library does, and are one piece each.
    """

    def __init__(self, path: str, common: dict[str, int]):
        super().__init__()
        self.tokenizer = load(path)
        self.common = common
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
        self.has_added = bool(added)
        # What the tokenizer makes of each single letter; words of them are made letter by letter.
        letters = re.findall(f"[{LATIN}]", "".join(map(chr, range(256))))
        self.letters = {ord(c): self.pre_tokens(c)[1][0] for c in letters}

    def pre_tokens(self, chunk: str) -> tuple[int, list[str]]:
        """Number of added tokens, and the pre-tokens of the text around them."""
        parts, found = [chunk], 0
        if self.has_added:
            parts = self.added.split(chunk)
            found = len(parts) - 1
        normalize = self.tokenizer.normalizer.normalize_str
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return found, [p for part in parts if part for p, _ in split(normalize(part))]

    def __missing__(self, chunk: str) -> tuple[int, tuple[str, ...]]:
        plain = PLAIN_WORD.fullmatch(chunk)
        if plain:
            pieces, tokens = 0, [plain[1].translate(self.letters), plain[2]]
            tokens = tokens if plain[2] else tokens[:1]
        else:
            pieces, tokens = self.pre_tokens(chunk)
        rare = []
        for token in tokens:
            known = self.common.get(token)
            if known is None:
                rare.append(token)
            else:
                pieces += known
        value = (pieces, tuple(rare))
        if len(self) < CACHED:
            self[chunk] = value
        return value

    def count(self, text: str) -> tuple[int, Counter]:
        pieces, rare = 0, Counter()
        for chunk, times in Counter(CHUNK.findall(text)).items():
            known, rest = self[chunk]
            pieces += known * times
            for token in rest:
                rare[token] += times
        return pieces, rare


def _frequencies(
    rows: DataFrame, tokenizer: str, common: Broadcast | None, with_docs: bool
) -> DataFrame:
    """Rows (row, token, times): the pre-tokens of each text that are not among the common ones.

    ``with_docs`` adds one row per text, under a token of its own, that carries doc_id, n_bytes and
    in ``times`` the pieces already counted.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(tokenizer, common.value if common else {})
        out: list[tuple] = []

        def flush(doc_type: pa.DataType) -> pa.RecordBatch:
            row, doc, token, size, times = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()),
                    pa.array(doc, doc_type),
                    pa.array(token, pa.string()),
                    pa.array(size, pa.int64()),
                    pa.array(times, pa.int64()),
                ],
                ["row", "doc_id", "token", "n_bytes", "times"],
            )

        for batch in batches:
            for row, doc, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                text = text or ""
                pieces, rare = chunks.count(text)
                if with_docs:
                    size = len(text.encode("utf-8", "surrogatepass"))
                    out.append((row, doc, f"\x00{row}", size, pieces))
                out.extend((row, None, token, None, times) for token, times in rare.items())
                if len(out) >= ROWS_AT_ONCE:
                    yield flush(batch.schema.field("doc_id").type)
            if out:
                yield flush(batch.schema.field("doc_id").type)

    return rows.mapInArrow(
        run,
        f"row bigint, doc_id {kind}, token string, n_bytes bigint, times bigint",
    )


def _count_pieces(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(token, pieces) of each distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = load(tokenizer).model.tokenize
        for batch in batches:
            pieces = [len(split(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pieces, pa.int64())], ["token", "pieces"]
            )

    return tokens.mapInArrow(run, "token string, pieces bigint")


def _common_pieces(rows: DataFrame, tokenizer: str) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens of a sample, ``COMMON`` at most."""
    n = rows.count()
    if not n:
        return {}
    sample = rows.filter(unit_hash(F.col("row")) < SAMPLE_DOCS / n)
    counted = _frequencies(sample, tokenizer, None, with_docs=False)
    top = (
        counted.groupBy("token")
        .agg(F.sum("times").alias("n"))
        .filter("n > 1")
        .orderBy(F.desc("n"), "token")
        .limit(COMMON)
    )
    return {r["token"]: r["pieces"] for r in _count_pieces(top.select("token"), tokenizer).collect()}


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the file of one whose pre-tokens never cross white space. Each distinct
    pre-token is cut into pieces once, and documents get the counts by joining on their pre-token
    frequencies; token ids are never made. Pre-tokens that are common in a sample of about
    ``SAMPLE_DOCS`` rows, ``COMMON`` at most, are joined by broadcast, the others by shuffle. Which
    ones are common changes the plan only, not the counts.

    Null and empty texts have 0 bytes and 0 tokens. Texts of any length are counted whole. Repeated
    rows and null ids get a row each. An empty table gives an empty result; other columns are not
    looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common_pieces(rows, tokenizer))
    frequencies = _frequencies(rows, tokenizer, common, with_docs=True)
    distinct = frequencies.filter("n_bytes IS NULL").select("token").distinct()
    pieces = _count_pieces(distinct, tokenizer)
    joined = frequencies.join(pieces, "token", "left").withColumn(
        "tokens", F.col("times") * F.coalesce("pieces", F.lit(1))
    )
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum("tokens").alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
