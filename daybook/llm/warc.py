"""Web archives: one gzip member per record on the way out, a sequential reader on the way in.

Records are WARC/1.1. A page is an HTTP response whose payload is its HTML; a
page whose payload another page already holds is a revisit, which has the HTTP
head and the digest but no payload.

Files are written by Spark's text writer, so they go to any folder that Spark
reaches, and a task that runs twice leaves one file. A gzip member ends with the
record's length as four bytes, least first, so for records below 16 MB its last
byte is zero: rows carry the member without that byte, and the line separator
is the zero byte. A longer record is followed by an empty member, which ends in
one too.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm.common import Work, ship, with_first

RECORDS_PER_FILE = 1000
#: Of two equal payloads of at least this many bytes, one is stored.
MIN_REVISIT_BYTES = 0
WARC_DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 16
_PAGE = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    digest = digest_text(payload)
    own = f"{_PAGE}{page_id}" if page_id is not None else f"urn:sha1:{digest}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{own}>"]
    head.append(f"WARC-Date: {WARC_DATE}")
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append(f"WARC-Block-Digest: sha1:{digest_text(block)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_PAGE}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """The record as a gzip member; its last byte is zero."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed if packed[-1] == 0 else packed + member(b"")


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What each gzip member holds; fed and unpacked bit by bit, one member in memory."""
    unpack, parts = zlib.decompressobj(31), []
    began = False
    for chunk in chunks:
        while chunk:
            began = True
            parts.append(unpack.decompress(chunk))
            chunk = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts, began = zlib.decompressobj(31), [], False
    if began:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Head and block of a record, framed by its content length, digests checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) < size or end != b"\r\n\r\n":
        raise ValueError("the block's length isn't the content length")
    _verify(fields.get("warc-block-digest"), block, "block")
    return fields, block


def _verify(told: str | None, data: bytes, what: str) -> str:
    """The SHA-1 of ``data``; an error if the record told another. It may tell none, or one of another kind."""
    digest = digest_text(data)
    if told and told.lower().startswith("sha1:") and told[5:].upper() != digest:
        raise ValueError(f"the {what}'s digest is wrong")
    return digest


def parsed_page(fields: dict[str, str], block: bytes) -> tuple | None:
    """A row of ``_READ``; None for a record that is no page: file and crawl facts, requests, conversions and the like."""
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit") or not block.startswith(b"HTTP/"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    told = [x[15:].strip() for x in head.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
    length = int(told[0]) if told and told[0].isdigit() else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        if length is not None and len(payload) != length:
            raise ValueError("the payload's length is wrong")
        digest, length = _verify(fields.get("warc-payload-digest"), payload, "payload"), len(payload)

    def number(uri: str) -> int | None:
        uri = uri.strip("<>")
        told = uri.removeprefix(_PAGE)
        return int(told) if uri.startswith(_PAGE) and told.lstrip("-").isdigit() else None

    refers_to = number(fields.get("warc-refers-to", "")) if kind == "revisit" else None
    return number(fields.get("warc-record-id", "")), length, digest, kind, refers_to, payload if kind == "response" else None


def write_archives(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write ``page_id, url, html`` as archive files of ``records_per_file`` records at most below ``path``.

    Of pages with equal HTML, that with the smallest ``page_id`` is a response
    (each of its rows, if the id repeats), the others are revisits of it. A null
    HTML is an empty payload. A page without an id is a response. Other columns
    are not read; an empty table gives no archive.
    """
    ship(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1(F.encode("html", "UTF-8"))).withColumn("size", F.octet_length("html"))
    first = (
        keyed.where(F.col("size") >= min_revisit_bytes)
        .groupBy("sha", "size")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    placed = with_first(keyed, ["sha", "size"], first, F.col("page_id")).select(
        "page_id", "url", "html", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("refers_to")
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, 256):
                columns = batch.slice(start, 256).to_pydict()
                made = [
                    member(record(page, url, html.encode(), refers))[:-1]
                    for page, url, html, refers in zip(*columns.values(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    (
        placed.mapInArrow(run, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", "\x00")
        .option("maxRecordsPerFile", records_per_file)
        .mode("overwrite")
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True, files: str = "*.txt") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and ``payload`` of every page.

    A revisit has no payload. A file that is cut off, a wrong length or a wrong
    digest is an error. Archives made elsewhere are read too, by the pattern ``files``:
    records of other types are skipped, digests that are missing are made, and a
    page without a number of ours has none. A file comes as one value, of 2 GB at most.
    """
    ship(spark)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for content in batch.column("content"):
                view = memoryview(content.as_buffer())
                rows: list[tuple] = []
                chunks = (bytes(view[i : i + _CHUNK]) for i in range(0, len(view), _CHUNK))
                for data in members(chunks):
                    if data:
                        row = parsed_page(*parse(data))
                        if row:
                            rows.append(row if payloads else (*row[:-1], None))
                    if len(rows) == 256:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path).select("content").mapInArrow(run, _READ)
    return found if payloads else found.drop("payload")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(columns, types, strict=True)], names=names
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the work folder and read them back."""
    work = Work(pages.sparkSession, "warc")
    path = work.path("archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads=False)
