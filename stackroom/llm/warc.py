"""WARC archives: written one gzip member per record, read back in sequence.

Writing. Of records with equal payloads (SHA-1 and length), the one with the largest page id
is a ``response`` with the payload; the others are ``revisit`` records that name it and hold
no payload. A task closes an archive when it holds ``ARCHIVE_BYTES``. Archives go through
Spark's own text writer, and so through its commit protocol and any file system Spark knows:
rows are members without their last byte, which is always zero (the high byte of a length
below 16 MiB; a longer record is followed by an empty member, whose last byte is zero too),
and the line separator is that zero byte. Files are therefore plain ``.warc.gz`` content,
though named ``part-*.txt``.

Reading. An archive is decompressed in small steps. Each member is one record: header lines
up to an empty line, then exactly as many bytes as ``Content-Length`` says, then the two line
ends that close it. The block digest of every record and the payload digest of every response
are computed again and compared; damage raises ``ValueError`` with the place.

Results for odd input: a null html is an empty payload; a null URL is left out of the header
and read back as null; line ends in a URL are written as spaces; of rows that repeat the
largest id each is a response; a row with a null id is a revisit if its payload has a row with
an id, else a response; an empty table has no archives and reads back empty. A task holds one
archive of bounded size, or one record where that is larger.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table

ARCHIVE_BYTES = 16 << 20
STEP = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()

RECORDS = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, "
    "refers_to bigint"
)


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member that ends with a zero byte."""
    digest = base32(hashlib.sha1(payload).digest())
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest))]
    fields += [("WARC-Date", DATE)]
    if url is not None:
        fields += [("WARC-Target-URI", re.sub(r"[\r\n]", " ", url))]
    if page_id is not None:
        fields += [("X-Page-Id", str(page_id))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()
    return packed if packed[-1] == 0 else packed + _EMPTY_MEMBER


def members(archive: bytes) -> Iterator[bytes]:
    """The decompressed members of an archive, one at a time."""
    at = 0
    while at < len(archive):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            step = archive[at : at + STEP]
            if not step:
                raise ValueError(f"archive ends inside the member before byte {at}")
            parts.append(unpacker.decompress(step))
            at += len(step)
        at -= len(unpacker.unused_data)
        if content := b"".join(parts):
            yield content


def parsed(record: bytes) -> tuple:
    """A member as a row of ``RECORDS``; framing and digests are verified."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.0":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']}: its length is not the one it states")
    if fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"record {fields['WARC-Record-ID']}: its block has another digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != stated or digest != base32(hashlib.sha1(payload).digest())):
        raise ValueError(f"record {fields['WARC-Record-ID']}: its payload has another digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return (
        number("X-Page-Id"),
        fields.get("WARC-Target-URI"),
        fields["WARC-Type"],
        None if revisit else payload,
        stated,
        digest,
        number("X-Refers-To-Page"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """A record for every row of ``pages``, in archives below ``path``. Payloads of fewer than
    ``min_bytes`` bytes are never revisited."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html")
    )
    rows = rows.withColumn("digest", F.concat_ws("-", F.sha1("html"), F.octet_length("html")))
    shared = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
    shared = shared.agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n"))
    shared = kept_table(shared.where("n > 1 and keep_id is not null").drop("n"), "payloads")
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    rows = rows.join(shared, "digest", "left").select("page_id", "url", "html", "keep_id", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for row in range(batch.num_rows):  # a record at a time: payloads may be large
                page_id, url, payload, keep_id, again = (c[row].as_py() for c in batch.columns)
                record = member(page_id, url, payload, keep_id, again)
                if size and size + len(record) > archive_bytes:
                    number, size = number + 1, 0
                size += len(record)
                name = pa.array([f"{task:06d}-{number:06d}"])
                yield pa.RecordBatch.from_arrays([pa.array([record[:-1]], pa.binary()), name], names=["record", "archive"])

    records = rows.mapInArrow(run, "record binary, archive string")
    lines = records.select(F.col("record").cast("string").alias("value"), "archive")
    lines.write.option("lineSep", "\0").option("compression", "none").partitionBy("archive").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records (``RECORDS``) of all archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for content in batch.column(0):
                for record in members(content.as_py()):
                    columns = [pa.array([v], t) for v, t in zip(parsed(record), types)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORDS)
