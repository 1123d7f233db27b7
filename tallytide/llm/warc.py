"""WARC archives: captures written as linked records and assembled again from them."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm.common import scratch_path, written
from tallytide.operators.sizing import lookup_join

VERSION = "WARC/1.1"
#: The digits of base 32 as Spark's ``conv`` and as the archive format spell them (fixed values).
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
RECORDS_AT_ONCE = 256
#: Records of one archive file at most, since a task reads a file whole.
RECORDS_PER_FILE = 30_000
RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target string, "
    "date string, payload_digest string, fields map<string,string>, payload binary, sound boolean"
)


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: each five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def record_id(*parts: Column) -> Column:
    """A URN that follows from the parts, so that a repeated task writes the same one."""
    h = F.md5(F.concat_ws("\x1f", *parts))
    pieces = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record up to its end mark, which the line separator of the file adds. Null headers go."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    head = F.concat_ws("\r\n", F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind), *lines)
    size = F.concat(F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"))
    return F.concat(head, size, F.lit(END), block)


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    date: str = "2020-01-01T00:00:00Z",
) -> None:
    """Write a request, a response or revisit and a metadata record for every page.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest id (then url)
    is the response, the others revisit it. Files are gzipped text whose line separator is the end
    mark of a record, of ``RECORDS_PER_FILE`` records at most. The winners of payloads meet the pages
    by a broadcast when they measure small, else by a join that spreads a payload shared by many
    pages.
    """
    address = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), "[\r\n]", "")
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        address.alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", payload_digest(F.col("html")))
    winners = rows.groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")
    )
    winners = winners.select(
        "digest",
        F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
        "n",
    )
    rows = lookup_join(rows, winners, "digest", rows="n")

    def name(role: str, page: str, address: str) -> Column:
        return record_id(
            F.lit(role),
            F.coalesce(F.col(page).cast("string"), F.lit("null")),
            F.col(address),
            F.col("digest"),
        )

    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("url") == F.col("first_url"))
    short = F.octet_length("html") < least_bytes
    kind = F.when(is_first | short, "response").otherwise("revisit")
    revisit = kind == "revisit"
    capture = name("capture", "page_id", "url")
    target = F.when(F.col("url") != "", F.col("url"))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", target)]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(END),
    )
    records = [
        _record(
            F.lit("request"),
            [
                ("WARC-Record-ID", name("request", "page_id", "url")),
                ("WARC-Concurrent-To", capture),
                *common,
                ("Content-Type", F.lit("application/http; msgtype=request")),
            ],
            F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{END}")),
        ),
        _record(
            kind,
            [
                ("WARC-Record-ID", capture),
                *common,
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                ("WARC-Refers-To", F.when(revisit, name("capture", "first_id", "first_url"))),
                ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
                ("Content-Type", F.lit("application/http; msgtype=response")),
            ],
            F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
        ),
        _record(
            F.lit("metadata"),
            [
                ("WARC-Record-ID", name("metadata", "page_id", "url")),
                ("WARC-Concurrent-To", capture),
                *common,
                ("Content-Type", F.lit("application/warc-fields")),
            ],
            F.concat_ws(
                "\r\n",
                F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                F.concat(F.lit("payload-bytes: "), F.octet_length("html").cast("string")),
                F.lit(""),
            ),
        ),
    ]
    lines = rows.select(F.explode(F.array(*records)).alias("value"))
    writer = lines.write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _headers(stream: BinaryIO) -> dict[str, str] | None:
    """Header lines up to the blank one, with names in lower case; None at the end of the file."""
    found: dict[str, str] = {}
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record starts with {line[:40]!r}")
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _intact(payload: bytes | None, digest: str | None) -> bool:
    """Whether a payload has the SHA-1 its header states; without either there is nothing to say."""
    if payload is None or not (digest or "").startswith("sha1:"):
        return True
    return base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest[5:]


def read_records(content: bytes) -> Iterator[dict]:
    """The records of one archive file, gzipped as a whole or record by record, or plain.

    A record is ``sound`` when its block is complete and its payload has the digest of its header.
    """
    raw: BinaryIO = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while (head := _headers(stream)) is not None:
        size = int(head["content-length"])
        block = stream.read(size)
        kind = head.get("warc-type")
        payload = None
        if kind in ("response", "resource"):
            is_http = head.get("content-type", "").startswith("application/http")
            payload = block.partition(b"\r\n\r\n")[2] if is_http else block
        yield {
            "type": kind,
            "record_id": head.get("warc-record-id"),
            "concurrent_to": head.get("warc-concurrent-to"),
            "refers_to": head.get("warc-refers-to"),
            "target": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "payload_digest": head.get("warc-payload-digest"),
            "fields": list(_fields(block).items()) if kind == "metadata" else None,
            "payload": payload,
            "sound": len(block) == size and _intact(payload, head.get("warc-payload-digest")),
        }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path`` as ``RECORD``. A task holds one file and a few records at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    texts = "type record_id concurrent_to refers_to target date payload_digest".split()
    schema = pa.schema(
        [
            *[(name, pa.string()) for name in texts],
            ("fields", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
            ("sound", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                part: list[dict] = []
                for record in read_records(content.as_py()):
                    part.append(record)
                    if len(part) == RECORDS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(part, schema)
                        part = []
                if part:
                    yield pa.RecordBatch.from_pylist(part, schema)

    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """One nested row per capture: its id, kind, target, date, digest, payload, and the request and
    metadata records that name it in WARC-Concurrent-To; ``refers_to`` is the record revisited, and
    ``also`` names further columns of the capture's record.

    All three sides are joined on the capture's record id. Records that repeat an id, as repeated
    input rows write them, are one; a capture without request or metadata keeps null there.
    """
    main = records.filter(F.col("type").isin("response", "revisit")).dropDuplicates(["record_id"])

    def attached(kind: str) -> DataFrame:
        nested = F.struct("record_id", "target", "date", "fields").alias(kind)
        of_kind = records.filter(F.col("type") == kind)
        return of_kind.select(F.col("concurrent_to").alias("record_id"), nested).dropDuplicates(
            ["record_id"]
        )

    captures = main.join(attached("request"), "record_id", "left")
    return captures.join(attached("metadata"), "record_id", "left").select(
        "record_id",
        "type",
        "target",
        "date",
        "payload_digest",
        "refers_to",
        "payload",
        "sound",
        "request",
        "metadata",
        *also,
    )


def restored(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Captures with page_id, ``refers_to_page``, and size and digest of the payload that was read.

    A revisit has those of the response it names. Size and digest are computed from the payload, not
    taken from headers or fields. The query fails on a record that is not sound, on a digest or size
    that is not the one stated, and on a revisit whose response is missing.
    """
    wrong = F.expr("raise_error(concat('archive record is not sound: ', record_id))")
    # size and digest are taken where the payloads are read, so that joins need not move payloads
    measured = records.withColumns(
        {
            "own_bytes": F.octet_length("payload").cast("bigint"),
            "own_digest": F.concat(F.lit("sha1:"), payload_digest(F.col("payload"))),
        }
    )
    captures = assemble(measured, also=("own_bytes", "own_digest")).withColumns(
        {
            "page_id": F.col("metadata.fields").getItem("page-id").cast(id_type),
            "stated_bytes": F.col("metadata.fields").getItem("payload-bytes").cast("bigint"),
        }
    )
    revisited = captures.filter("refers_to IS NOT NULL").groupBy("refers_to").agg(F.count("*").alias("n"))
    responses = captures.filter("type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("refers_to_page"),
        F.col("own_bytes").alias("seen_bytes"),
        F.col("own_digest").alias("seen_digest"),
    )
    named = revisited.join(responses, "refers_to")
    found = lookup_join(captures, named, "refers_to", "left", rows="n")
    size, digest = F.coalesce("own_bytes", "seen_bytes"), F.coalesce("own_digest", "seen_digest")
    agrees = F.col("sound") & (digest == F.col("payload_digest")) & (size == F.col("stated_bytes"))
    sound = F.coalesce(agrees, F.lit(False))
    return found.withColumns(
        {
            "payload_bytes": F.when(sound, size).otherwise(wrong.cast("bigint")),
            "payload_digest": F.when(sound, digest).otherwise(wrong),
        }
    ).drop("stated_bytes", "own_bytes", "own_digest", "seen_bytes", "seen_digest")


def archive_round_trip(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and assemble the captures.

    Adds page_id from the metadata, payload_bytes and payload_digest of the payload read back, and
    ``refers_to_page``, the page revisited; see ``restored``.

    Null payloads and urls are empty. Rows that repeat id, url and payload are one capture; rows
    that share an id only are captures of their own. A null id is written and read as null, and
    comes below all others when a response is chosen. An empty table gives an empty result; other
    columns are not written.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, page_id, url, html, least_bytes)
    records = written(read_archives(spark, path), "records")
    return restored(records, pages.schema[page_id].dataType.simpleString())
