"""Web archives without repeated payloads: revisit records resolved by payload digest.

Headers are shuffled by payload digest; the page with the largest id of each digest is its
response, the others become revisit records that name it. Each task writes the records it holds to
archives of bounded size, one gzip member per record, with fresh headers. Reading joins revisit
records to the responses that carry the same digest.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import fresh_folder, open_folder, ship_package
from ledgermill.session import written

ARCHIVE_BYTES = 512 << 20
LEVEL = 1
READ_BYTES = 1 << 20
HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), HEX_DIGITS, BASE32_DIGITS)


def _records(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """``page_id, url, payload, digest, refers`` of each record; refers is null for a response."""
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages[payload_col].cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    headers = rows.where(F.octet_length("payload") >= least_bytes).select("page_id", "digest")
    originals = headers.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    # Payloads that occur once need no join; the others meet their original by digest.
    originals = written(originals.where("n > 1").drop("n"), "original-responses")
    revisits = headers.join(originals, "digest").where("not (page_id <=> original)").distinct()
    revisits = written(revisits, "revisits").withColumnRenamed("page_id", "r_page").withColumnRenamed("digest", "r_digest")
    found = rows.join(revisits, F.expr("page_id <=> r_page and digest = r_digest"), "left")
    return found.select("page_id", "url", "payload", "digest", F.col("original").alias("refers"))


def _record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers: int | None, date: str) -> bytes:
    name = "none" if page_id is None else page_id
    head = HTTP_HEAD.format(len(payload)).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_URN}{name}>",
        f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_URN}{refers}>"]
    block = head if refers is not None else head + payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    spark: SparkSession,
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    date: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Writes one record per row and returns the table ``file, records`` of the archives that count.

    Of rows with equal payloads of ``least_bytes`` or more, that with the largest id is the
    response and the others revisit it. A null payload is empty. Rows with equal id and payload
    all have the type of that id; among rows of the largest id each is a response. A null id is
    smaller than any other. A task that runs again writes new files; those of a failed attempt are
    not in the table. An empty table gives no archive.
    """
    ship_package(spark)
    folder = folder or fresh_folder(spark, "warc")
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out, path, size, records = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["file", "records"])

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    path = os.path.join(folder, f"part-{task:08d}-{uuid.uuid4().hex}.warc.gz")
                    fs, plain = open_folder(path)
                    fs.create_dir(os.path.dirname(plain), recursive=True)
                    out, size, records = fs.open_output_stream(plain, compression=None), 0, 0
                packer = zlib.compressobj(LEVEL, wbits=31)
                member = packer.compress(_record_bytes(*row, date)) + packer.flush()
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    records = _records(pages, least_bytes, id_col, url_col, payload_col)
    return written(records.mapInArrow(run, "file string, records long"), "archives")


def _stream(source: pa.NativeFile) -> Iterator[bytes]:
    """The unpacked bytes of each gzip member, one after the other."""
    rest = b""
    while True:
        unpacker, parts = zlib.decompressobj(wbits=31), []
        while not unpacker.eof:
            chunk = rest or source.read(READ_BYTES)
            rest = b""
            if not chunk:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(unpacker.decompress(chunk))
        rest = unpacker.unused_data
        yield b"".join(parts)


def _page(urn: str) -> int | None:
    name = urn.strip().removeprefix(f"<{RECORD_URN}").removesuffix(">")
    return None if name == "none" else int(name)


def _parse(record: bytes) -> tuple[int | None, str, str, str, int | None, int | None]:
    """Page id, type, target, digest, refers-to and payload bytes (None for a revisit) of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]}")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
        return _page(fields["warc-record-id"]), "response", fields["warc-target-uri"], digest, None, len(payload)
    refers = _page(fields["warc-refers-to"])
    return _page(fields["warc-record-id"]), "revisit", fields["warc-target-uri"], digest, refers, None


HEADERS = "page_id long, record_type string, url string, payload_digest string, refers_to long, payload_bytes long"


def read_headers(archives: DataFrame) -> DataFrame:
    """One row per record of the archives in ``file``; payload_bytes is null for revisit records."""
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in HEADERS.split(", ")]
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, plain = open_folder(file)
                with fs.open_input_stream(plain, compression=None) as source:
                    rows = []
                    for record in _stream(source):
                        rows.append(_parse(record))
                        if len(rows) == 4096:
                            yield _batch(rows, kinds, names)
                            rows = []
                    if rows:
                        yield _batch(rows, kinds, names)

    # A few names stand for much data: as many tasks as archives, which adaptive execution must not join.
    return archives.select("file").repartition(max(1, archives.count())).mapInArrow(run, HEADERS)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def resolve(headers: DataFrame) -> DataFrame:
    """Joins revisit records to the response they name, by digest and record.

    Adds the payload size of the original. A revisit record whose response is missing keeps a null
    size. Responses need no join.
    """
    originals = headers.where("record_type = 'response'").select(
        F.col("payload_digest").alias("o_digest"), F.col("page_id").alias("o_page"), F.col("payload_bytes").alias("o_bytes")
    ).dropDuplicates(["o_digest", "o_page"])
    originals = written(originals, "responses")
    revisits = headers.where("record_type = 'revisit'").join(
        originals, F.expr("payload_digest = o_digest and refers_to <=> o_page"), "left"
    )
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return headers.where("record_type = 'response'").select(*names).unionByName(
        revisits.select("page_id", F.col("o_bytes").alias("payload_bytes"), *names[2:])
    )


def write_and_read_back(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes archives and resolves what is read from them: one row per page."""
    return resolve(written(read_headers(write_archives(spark, pages, least_bytes=least_bytes)), "warc-headers"))
