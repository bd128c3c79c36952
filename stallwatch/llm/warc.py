"""WARC archives: one gzip member per record, written by tasks and read back as a stream.

The reader feeds a zlib decompressor block by block. A member holds one record: header lines, a blank line,
as many bytes as Content-Length says, and two line ends. Block and payload digests are verified.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwatch.llm.scratch import Scratch, open_file, write_file

READ_BYTES = 1 << 16
#: A task starts a new archive once this much is written.
ARCHIVE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"


class BadRecord(ValueError):
    """A record that breaks the format or fails a digest."""


def record(kind: str, record_id: str, uri: str, block: bytes, headers: dict[str, str]) -> bytes:
    """One record as one gzip member."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, "WARC-Target-URI": uri, "Content-Type": "application/http; msgtype=response"}
    lines |= headers | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head.encode()) + press.compress(block) + press.compress(b"\r\n\r\n") + press.flush()


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, in order. Raises BadRecord."""
    rest = stream.read(READ_BYTES)
    while rest:
        press = zlib.decompressobj(31)
        data = bytearray()
        headers: dict[str, str] | None = None
        start = need = 0
        while True:
            try:
                data += press.decompress(rest)
            except zlib.error as e:
                raise BadRecord(f"not a gzip member: {e}") from None
            if headers is None and (end := data.find(b"\r\n\r\n")) >= 0:
                lines = data[:end].decode().split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise BadRecord("no WARC version line")
                headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                start = end + 4
                if not headers.get("content-length", "").isdigit():
                    raise BadRecord("no Content-Length")
                need = start + int(headers["content-length"]) + 4
            if headers is not None and len(data) > need:
                raise BadRecord("longer than its Content-Length")
            if press.eof:
                rest = press.unused_data or stream.read(READ_BYTES)
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise BadRecord("ends inside a record")
        if headers is None or len(data) != need or data[-4:] != b"\r\n\r\n":
            raise BadRecord("shorter than its Content-Length")
        block = bytes(data[start : need - 4])
        if (said := headers.get("warc-block-digest")) and said != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise BadRecord("block digest differs")
        yield headers, block


def payload_of(headers: dict[str, str], block: bytes) -> tuple[int, str, bytes | None]:
    """Length, digest and, of a response, the payload. A revisit tells them of the payload it leaves out."""
    head, _, body = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "revisit":
        return int(http["content-length"]), digest, None
    if hashlib.sha256(body).hexdigest() != digest:
        raise BadRecord("payload digest differs")
    return len(body), digest, body


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        held, made = io.BytesIO(), []

        def close() -> None:
            nonlocal held
            # Names belong to one attempt: what an attempt leaves behind that is not the last one, no reader is told of.
            name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(made):04d}.warc.gz"
            write_file(name, held.getvalue())
            made.append((name, held.tell()))
            held = io.BytesIO()

        for batch in batches:
            for page, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                body = (html or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                own = {"WARC-Payload-Digest": f"sha256:{digest}"}
                uri = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
                page_id = "" if page is None else page
                if first is None:
                    held.write(record("response", f"urn:page:{page_id}", uri, http + body, own))
                else:
                    own |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{first}>"}
                    held.write(record("revisit", f"urn:page:{page_id}", uri, http, own))
                if held.tell() >= ARCHIVE_BYTES:
                    close()
        if held.tell():
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in made], t) for i, t in ((0, pa.string()), (1, pa.int64()))], names=["archive", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, min_bytes: int = 100) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); returns (archive, bytes), already written.

    Null html is empty. Of rows whose payloads are equal and have ``min_bytes`` or more, those with the
    smallest page_id are responses, all others revisits of it. A null page_id is never the smallest.
    Archives are named by attempt, and those named in the result hold each record once: a task that ran
    twice leaves files that the result does not name. ``folder`` is a URI that pyarrow opens (file, hdfs, s3, gs).
    Smaller payloads are written where they are read; larger ones move once, to meet their digest's smallest id
    (a plain join, which Spark splits where one digest has many pages).
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    signed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("digest"))
    large, small = signed.where(F.octet_length(payload) >= min_bytes), signed.where(F.octet_length(payload) < min_bytes)
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = scratch.table(groups.where("n > 1 and first is not null").select("digest", "first"), "groups")
    linked = large.join(groups, "digest", "left").withColumn("first", F.when(F.col("page_id") == F.col("first"), None).otherwise(F.col("first")))
    columns = ["page_id", "url", "html", "digest", "first"]
    rows = linked.select(columns).unionByName(small.withColumn("first", F.lit(None).cast("long")).select(columns))
    return scratch.table(rows.mapInArrow(_writer(folder), "archive string, bytes long"), "archives")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(archive) of all archives in a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(F.col("path").alias("archive"))


PAGE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, html]) of the records of ``archives`` (archive).

    Tasks read archives as streams, a record at a time. Without archives there are no rows.
    """
    schema = PAGE + ", html string" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def page(name: str | None) -> int | None:
        number = (name or "").strip("<>").removeprefix("urn:page:")
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                with open_file(archive) as stream:
                    for headers, block in read_records(stream):
                        size, digest, body = payload_of(headers, block)
                        row = (page(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, headers["warc-type"], page(headers.get("warc-refers-to")))
                        rows.append(row + ((None if body is None else body.decode(),) if with_payload else ()))
                        held += len(block)
                        if len(rows) >= 2000 or with_payload and held >= ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return archives.select("archive").repartition("archive").mapInArrow(run, schema)


def round_trip(pages: DataFrame, with_payload: bool = False, min_bytes: int = 100) -> DataFrame:
    """Writes archives into the shared folder and reads those of the finished attempts back. An empty table gives no rows."""
    scratch = Scratch(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, scratch.path("files"), scratch, min_bytes), with_payload)
