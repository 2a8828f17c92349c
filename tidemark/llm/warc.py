"""WARC archives compressed with Zstandard: writing, and reading with full validation.

An archive starts with a skippable frame that holds the dictionary; then every record is a frame of its
own. Archives are rows of bytes, which Spark writes and reads like any table; ``read_archives`` also
takes files through Spark's binary file source.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, cut, small, table, text_of, to_batch

#: Fixed values of the format: frame magics, version line, revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID = "urn:tidemark:page:"
#: Payloads of fewer bytes are always stored in full.
LEAST_SHARED_BYTES = 1000
#: Digests of repeated payloads that may be copied to every executor, of 40 bytes each.
SHARED_ROWS = 400_000
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

ARCHIVE = "archive binary"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class BadArchive(ValueError):
    """Bytes that are not a valid archive."""


# -- writing


def header_value(value: str) -> str:
    """A header's value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One record. A revisit keeps the HTTP header, which has the payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the tables have no time of capture
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes]) -> bytes:
    """An archive whose dictionary is a sample of its own records."""
    share = max(256, DICTIONARY_BYTES // max(1, len(records)))
    sample = b"".join(r[:share] for r in records)[:DICTIONARY_BYTES]
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw_dictionary(sample)).compress
    head = DICTIONARY_MAGIC.to_bytes(4, "little") + len(sample).to_bytes(4, "little") + sample
    return head + b"".join(map(compress, records))


def raw_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, waiting, held = arrow_schema(ARCHIVE), [], 0
    for batch in batches:
        columns = (batch.column(n) for n in ("page_id", "url", "record_type", "refers_to", "payload_digest", "html"))
        for values in zip(*columns):  # scalars, turned to Python one row at a time
            page_id, url, kind, refers_to, digest, html = (v.as_py() for v in values)
            waiting.append(record_bytes(page_id, url, kind, refers_to, digest, html.encode()))
            held += len(waiting[-1])
            if held >= ARCHIVE_BYTES:
                yield to_batch({"archive": [archive_bytes(waiting)]}, schema)
                waiting, held = [], 0
    if waiting:
        yield to_batch({"archive": [archive_bytes(waiting)]}, schema)


# -- reading


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts here ends, from its header and the sizes of its blocks."""
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        if at + 3 > len(data):
            raise BadArchive("a frame ends early")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        if kind == 3:
            raise BadArchive("unknown kind of block")
        at += 3 + (1 if kind == 1 else size)
    at += 4 * checksum
    if at > len(data):
        raise BadArchive("a frame ends early")
    return at


def frames(archive: bytes) -> Iterator[bytes]:
    """The content of every frame; the leading skippable frame is the dictionary."""
    data, at = memoryview(archive), 0
    dictionary = None
    if len(data) < 8:
        raise BadArchive("no frame")
    if int.from_bytes(data[:4], "little") == DICTIONARY_MAGIC:
        at = 8 + int.from_bytes(data[4:8], "little")
        if at > len(data):
            raise BadArchive("the dictionary ends early")
        found = bytes(data[8:at])
        if found[:4] == FRAME_MAGIC.to_bytes(4, "little"):  # a dictionary may be compressed itself
            found = zstandard.ZstdDecompressor().decompress(found)
        trained = found[:4] == (0xEC30A437).to_bytes(4, "little")
        dictionary = zstandard.ZstdCompressionDict(found) if trained else raw_dictionary(found)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic >> 4 == 0x184D2A5:
            at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if at > len(data):
                raise BadArchive("a skippable frame ends early")
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive(f"no frame at byte {at}")
        end = frame_end(data, at)
        try:
            yield reader.decompressobj().decompress(data[at:end])
        except zstandard.ZstdError as error:
            raise BadArchive(f"frame at byte {at}: {error}") from error
        at = end


def headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise BadArchive(f"bad header line {line[:80]!r}")
        if (key := name.decode().lower()) in out:
            raise BadArchive(f"header {key} twice")
        out[key] = value.strip().decode()
    return out


def number(found: dict[str, str], name: str) -> int:
    if not re.fullmatch(r"\d+", found.get(name, "")):
        raise BadArchive(f"{name} is missing or no number")
    return int(found[name])


def page_of(value: str | None) -> int | None:
    if value is None or not (m := re.fullmatch(rf"<{ID}(-?\d*)>", value)):
        raise BadArchive(f"bad record id {value!r}")
    return int(m[1]) if m[1] else None


def parse_record(record: bytes) -> tuple:
    """Check a record and return the values of RECORD. Raises BadArchive where something doesn't fit."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not blank:
        raise BadArchive("not a record")
    found = headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in found:
            raise BadArchive(f"{name} is missing")
    length = number(found, "content-length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive("the block's length differs from its header")
    status, blank, payload = rest[:length].partition(b"\r\n\r\n")
    first, _, http_lines = status.partition(b"\r\n")
    if not blank or not first.startswith(b"HTTP/"):
        raise BadArchive("no HTTP response")
    size = number(headers(http_lines), "content-length")
    scheme, _, encoded = found["warc-payload-digest"].partition(":")
    if scheme != "sha1" or not re.fullmatch("[A-Z2-7]{32}", encoded):
        raise BadArchive("unknown digest")
    digest = base64.b32decode(encoded).hex()
    kind = found["warc-type"]
    if kind == "revisit":
        if payload or "warc-refers-to" not in found:
            raise BadArchive("a revisit has a payload or no record it refers to")
        refers_to, payload = page_of(found["warc-refers-to"]), None
    elif kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive("the payload's length or digest differs from its header")
        refers_to = None
    else:
        raise BadArchive(f"unknown type {kind!r}")
    return page_of(found["warc-record-id"]), found.get("warc-target-uri"), kind, refers_to, size, digest, payload


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(RECORD)
    for batch in batches:
        for archive in batch.column(0):
            rows, held = [], 0
            for frame in frames(archive.as_py()):
                rows.append(parse_record(frame))
                held += len(frame)
                if held >= ARCHIVE_BYTES:
                    yield to_batch(dict(zip(schema.names, zip(*rows))), schema)
                    rows, held = [], 0
            if rows:
                yield to_batch(dict(zip(schema.names, zip(*rows))), schema)


# -- operators


def record_plan(pages: DataFrame) -> DataFrame:
    """The records to write: page_id, url, html, payload_digest, record_type, refers_to.

    Payloads that occur more than once are found by their digests alone. A table of them that is counted to
    be small is copied to the tasks that read the pages, so that no html is shuffled; a larger one meets the
    pages by a shuffle, where a digest's pages may be any share of all, and AQE splits them.
    """
    text = text_of("html")
    rows = pages.select("page_id", "url", text.alias("html")).withColumn("payload_digest", F.sha1(F.encode("html", "UTF-8")))
    shared = (
        rows.where(F.octet_length("html") >= LEAST_SHARED_BYTES)
        .groupBy(F.col("payload_digest").alias("shared"))
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1 AND last IS NOT NULL")
    )
    shared = small(cut(shared), SHARED_ROWS)
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(shared, F.col("payload_digest") == F.col("shared"), "left").select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).cast("long").alias("refers_to"),
    )


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives, one row each, of a record per row of ``pages`` (page_id, url, html).

    A null html is an empty payload, a null url leaves its header out. Of equal payloads of at least
    ``LEAST_SHARED_BYTES`` the row with the largest page_id is the response (all rows that repeat this
    id), the others revisit it; a page_id that is null is smaller than any, and payloads whose pages all
    have none are all responses. Further columns are ignored; an empty table gives no archive.
    """
    return record_plan(pages).mapInArrow(write_batches, ARCHIVE)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (one column of bytes). A record that doesn't fit its headers fails the job."""
    return archives.mapInArrow(read_batches, RECORD)


def read_archive_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of .warc.zst files below a path."""
    return read_archives(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).select("content"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = cut(write_archives(table(spark, sf_dir, "pages")))
    return read_archives(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.last IS NULL OR g.last = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
