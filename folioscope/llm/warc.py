"""Operator 6, WARC: archives written with an index first, then read back through it.

Each task writes its pages as WARC/1.1 records, one gzip member a record, to files of its own in the shared folder, and yields an index row
for each: file, offset, length, URL and payload digest. The index is a table of its own; only files that it names count, so
what a lost or repeated task left behind is never read. Reading sorts the selected index rows by file and offset, joins
ranges that touch or nearly touch into one read, and cuts the records out of it.

Of records with equal payloads (SHA-1) of at least ``min_bytes``, the one with the largest page_id is the response and the others
are revisits that hold its id and no payload.

Defined cases: a null payload is empty, and one of any length is one record; a null page_id reads back as null and is smaller than all others, so that
pages without ids revisit one with an id, or are all responses; a null or odd URL is percent-encoded; rows that repeat both page_id and payload
are all responses where that page is the response, and else all revisits; no pages give an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROWS_PER_BATCH, Scratch, partitions, slices

FILE_BYTES, GAP_BYTES, READ_BYTES = 256 << 20, 64 << 10, 8 << 20
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pages").int >> 64
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record_id(page_id: int | None, digest: str = "") -> str:
    """A UUID whose lower half is the page's id; for a page without one, a UUID of its payload's digest."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>"
    return f"<urn:uuid:{uuid.UUID(int=_NAMESPACE << 64 | (page_id & (1 << 64) - 1))}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.strip().removeprefix("<urn:uuid:").removesuffix(">")).int
    if number >> 64 != _NAMESPACE:
        return None
    low = number & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    target = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    body = http
    if refers_to is None:
        body += payload
    else:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def decode_record(member: bytes) -> dict:
    """The headers, the payload (None in a revisit) and its length."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(fields["content-length"])
    if not version.startswith("WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    n = int(re.search(rb"content-length: (\d+)", http, re.I)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != n or digest_of(payload) != digest):
        raise ValueError("a payload does not match its digest")
    return {"page_id": page_of(fields["warc-record-id"]), "payload": payload if kind == "response" else None, "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None, "url": fields["warc-target-uri"]}


def _open(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for b in slices(batches):
            rows = []
            for page_id, html, url, refers_to in zip(*(c.to_pylist() for c in b.columns[:4]), strict=True):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = html.encode()
                digest = digest_of(payload)
                member = encode_record(page_id, url, payload, digest, refers_to)
                out.write(member)
                rows.append((name, at, len(member), page_id, url, digest))
                at += len(member)
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "offset", "length", "page_id", "url", "payload_digest"), r, strict=True)) for r in rows], schema=_arrow(INDEX))
        if out is not None:
            out.close()

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def write_archives(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> tuple[DataFrame, str]:
    """The index of the archives and the folder they are in."""
    texts = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.col("url").cast("string").alias("url")).withColumn("digest", F.sha1("html"))
    digests = scratch.save(texts.select("page_id", F.octet_length("html").alias("size"), "digest"), "digests").where(F.col("size") >= min_bytes)
    chosen = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisits = scratch.save(digests.join(chosen, "digest").where("refers_to is not null and not page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")
    root = f"{scratch.base}/warc"
    own = revisits.withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    joined = texts.join(own, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    index = joined.select("page_id", "html", "url", "refers_to").mapInArrow(_writer(root), INDEX)
    return scratch.save(index, "index"), root


def coalesce_ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, members) of joint reads for (offset, length) rows sorted by offset."""
    reads: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in rows:
        if reads and offset - reads[-1][1] <= GAP_BYTES and offset + length - reads[-1][0] <= READ_BYTES:
            start, end, members = reads[-1]
            members.append((offset, length))
            reads[-1] = (start, max(end, offset + length), members)
        else:
            reads.append((offset, offset + length, [(offset, length)]))
    return reads


def read_records(index: DataFrame, root: str) -> DataFrame:
    """The records that the index rows select, by coalesced byte-range reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        name, source = None, None
        for b in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for f, o, n in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True):
                by_file.setdefault(f, []).append((o, n))
            for f, rows in by_file.items():
                if f != name:
                    if source is not None:
                        source.close()
                    name, source = f, store.open_input_file(f"{base}/{f}")
                for start, end, members in coalesce_ranges(rows):
                    block = source.read_at(end - start, start)
                    found = [decode_record(block[o - start : o - start + n]) for o, n in members]
                    for r in found:
                        r.pop("payload")
                    yield pa.RecordBatch.from_pylist(found, schema=_arrow(RECORD))
        if source is not None:
            source.close()

    placed = index.select("file", "offset", "length").repartitionByRange(partitions(index.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, RECORD)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per page, as read back from the archives."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    index, root = write_archives(pages, scratch, min_bytes)
    return read_records(index, root)
