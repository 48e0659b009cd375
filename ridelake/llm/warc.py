"""WARC archives: one gzip member per record, payload dedup by revisit records, and a sequential reader.

Archives are written by Spark's text writer, so its committer deals with lost executors on any storage.  A text file is its
rows with a separator after each.  A gzip member ends with the top byte of the record's length, which is NUL for records
under 16 MiB; that NUL is the separator.  A longer record is followed by an empty member, which readers skip.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = b"\r\n\r\n"
_NO_DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """A damaged archive."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _field(text: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def _record_id(page, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{payload_digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` without the payload."""
    payload_digest = digest(payload)
    block = _HTTP if refers_to is not None else _HTTP + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page, payload_digest)),
        ("WARC-Date", _NO_DATE),
        ("WARC-Target-URI", _field(url or f"urn:page:{page}")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to, payload_digest)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + _END


def read_members(stream: BinaryIO, chunk: int = 65_536) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, decompressed a chunk at a time; empty members are skipped."""
    left = b""
    while data := left or stream.read(chunk):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                raise WarcError("the archive ends inside a gzip member")
            try:
                parts.append(unpacker.decompress(data))
            except zlib.error as error:
                raise WarcError(f"bad gzip member: {error}") from error
            data = b"" if unpacker.eof else stream.read(chunk)
        left = unpacker.unused_data
        if content := b"".join(parts):
            yield content


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields, block)`` of each record; field names in lower case.  Framing and digests are verified."""
    for content in read_members(stream):
        head, blank, rest = content.partition(_END)
        version, *lines = head.split(b"\r\n")
        if not blank or not version.startswith(b"WARC/"):
            raise WarcError("a member does not start with a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}
        length = int(fields.get("content-length", -1))
        if length < 0 or rest[length:] != _END:
            raise WarcError(f"content length does not frame the record {fields.get('warc-record-id')}")
        block = rest[:length]
        payload = block.partition(_END)[2]
        checks = [("warc-block-digest", block)] + [("warc-payload-digest", payload)] * (fields.get("warc-type") == "response")
        for name, data in checks:
            if name in fields and fields[name] != f"sha1:{digest(data)}":
                raise WarcError(f"{name} does not match in {fields.get('warc-record-id')}")
        yield fields, block


def _members(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            for page, url, html, refers_to in zip(part["id"].to_pylist(), part["url"].to_pylist(), part["html"].cast(pa.binary()).to_pylist(), part["refers_to"].to_pylist(), strict=True):
                member = gzip_member(record(page, url, html or b"", refers_to), level)
                while member[-1]:
                    member += gzip_member(b"")
                out.append(member[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = 16_000_000, level: int = 6) -> None:
    """One record per row, in archives of about ``archive_bytes`` of payload.

    Of rows with equal payloads (null: empty) the one with the largest id is a response, the others revisit it.  Rows that
    share that id and payload are all responses; so are rows of a payload that has no id at all.  A row without an id whose
    payload others hold revisits them.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("payload_sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn("page_key", F.coalesce(F.col("id").cast("string"), F.lit("?")))
    # Only ids and digests meet to find the holder of each payload; the pages join its answer by id.
    keys = rows.select("id", "page_key", "payload_sha")
    holders = keys.groupBy("payload_sha").agg(F.max("id").alias("holder"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisits = keys.join(holders, "payload_sha").filter(~F.col("id").eqNullSafe(F.col("holder")) & F.col("holder").isNotNull()).select("page_key", "payload_sha", F.col("holder").alias("refers_to")).distinct()
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    # Pages are dealt into archives once, by the keys of the join, which then needs no further shuffle of them.
    archives = max(-(-total // archive_bytes), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(archives, "page_key", "payload_sha").join(revisits, ["page_key", "payload_sha"], "left").select("id", "url", "html", "refers_to")
    dealt.mapInArrow(lambda batches: _members(batches, level), "member binary").select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in read_records(io.BytesIO(content.as_buffer())):
                rows.append((*(fields.get(k) for k in ("x-page-id", "warc-target-uri", "warc-type", "x-refers-to-page-id")), fields["warc-payload-digest"].removeprefix("sha1:"), fields.get("x-payload-length"), block.partition(_END)[2]))
                if len(rows) == 512:
                    yield _table(rows)
                    rows = []
            if rows:
                yield _table(rows)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    number = lambda values: pa.array([None if v is None else int(v) for v in values], pa.int64())
    page, url, kind, refers_to, payload_digest, length, payload = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([number(page), pa.array(url), pa.array(kind), number(refers_to), pa.array(payload_digest), number(length), pa.array(payload, pa.binary())], ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, read one after the other in each.  A revisit's payload is empty."""
    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parsed, schema)
