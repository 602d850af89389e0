"""WARC archives with revisit records.

Headers (not payloads) are shuffled by payload digest to find the payloads that
several pages share.  Every task then writes one archive of its own pages, responses
with and revisits without the payload, into the shared folder.  What is read back,
record by record, are headers again: revisit records are joined to the original
responses by payload digest, which says what they refer to and how long it is.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_schema, small_or_plain, small_slices, staged, work_dir

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value: the base32 alphabet of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

ARCHIVES = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType())])
#: Headers as they are read; a revisit's length and what it refers to come from its original.
HEADERS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
    ]
)


def with_revisits(pages: DataFrame, payload: str = "html", least_bytes: int = 0, max_broadcast: int = 500_000) -> DataFrame:
    """(page_id, url, payload, sha1, revisit, original_url): of equal payloads the largest page_id is the original.

    A null payload is empty; a null page_id is less than any other, and where all of
    a payload's ids are null, all are responses.  Rows that repeat the original's
    page_id are responses too.  Payloads under ``least_bytes`` are never shared.

    Payloads that occur once need no row of the join's other side, so that is short;
    under ``max_broadcast`` rows and a bound on bytes it is broadcast, and no payload
    is shuffled.  Beyond that pages are joined by digest, where skewed digests are split.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary"))
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), body.alias("payload")).withColumn("sha1", F.unhex(F.sha1("payload")))
    # narrow rows, partial aggregation: a payload that a third of all pages share is one row per task
    headers = rows.where(F.octet_length("payload") >= least_bytes).groupBy(F.col("sha1").alias("o_sha1"))
    shared = headers.agg(F.max(F.struct("page_id", "url")).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 and original.page_id is not null")
    shared = staged(shared.select("o_sha1", F.col("original.page_id").alias("o_id"), F.col("original.url").alias("original_url")), "warc-shared")
    joined = rows.join(small_or_plain(shared, max_broadcast, "o_sha1", "original_url"), F.col("sha1") == F.col("o_sha1"), "left")
    revisit = F.col("o_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("o_id"))
    return joined.select("page_id", "url", "payload", "sha1", revisit.alias("revisit"), "original_url")


def _header(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, record_id: uuid.UUID, date: str, revisit: bool = False, original_url: str | None = None) -> bytes:
    """One gzip member with fresh headers."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    fields = [
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha1).decode()}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if not revisit:
        return gzip.compress(_header("response", fields, http + payload), 1, mtime=0)
    # the original is of the same run, so it has the same date
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Target-URI", _uri(original_url)), ("WARC-Refers-To-Date", date)]
    return gzip.compress(_header("revisit", fields, http), 1, mtime=0)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task into ``folder``; the (archive, records) that were written.

    A task writes under a name of its own attempt; only archives that its result
    names are read, so lost or doubled attempts do no harm.  Dates are the run's;
    record ids are named by run, partition and place, so no two are equal and a
    retried task writes the same records.
    """
    date, space = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), uuid.uuid5(_NAMESPACE, folder)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        n = 0
        with store.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                for part in small_slices(*batch.columns):
                    for values in zip(*(c.to_pylist() for c in part), strict=True):
                        row = dict(zip(names, values, strict=True))
                        out.write(record(record_id=uuid.uuid5(space, f"{context.partitionId()} {n}"), date=date, **row))
                        n += 1
        yield pa.RecordBatch.from_pylist([{"archive": f"{folder}/{name}", "records": n}], schema=arrow_schema(ARCHIVES))

    return rows.mapInArrow(run, ARCHIVES)


def read_members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    inflate, out, data = zlib.decompressobj(31), [], b""
    while data := data or stream.read(size):
        out.append(inflate.decompress(data))
        data = b""
        if inflate.eof:
            yield b"".join(out)
            data, inflate, out = inflate.unused_data, zlib.decompressobj(31), []


def parse_record(member: bytes) -> dict:
    """Headers and block of a record; checks the block's length and, for responses, the payload's digest."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("a record's length doesn't fit its header")
    payload = block.partition(b"\r\n\r\n")[2]
    digest, is_response = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
    if is_response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError("a payload doesn't fit its digest")
    return {
        "page_id": int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None,
        "url": fields["WARC-Target-URI"],
        "payload_bytes": len(payload) if is_response else None,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "record_id": fields["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">"),
        "fields": fields,
        "payload": payload if is_response else None,
    }


def read_archives(archives: DataFrame, per_batch: int = 1000) -> DataFrame:
    """One row per record of the archives, streamed: a task holds one record's payload at a time."""
    schema = arrow_schema(HEADERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                store, path = fs.FileSystem.from_uri(archive)
                rows = []
                with store.open_input_stream(path, compression=None) as stream:
                    for member in read_members(stream):
                        row = parse_record(member)
                        rows.append({k: row[k] for k in HEADERS.names})
                        if len(rows) >= per_batch:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return archives.mapInArrow(run, HEADERS)


def archive_pages(pages: DataFrame, payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write all pages as deduplicated archives and return the archives' names and record counts."""
    return staged(write_archives(with_revisits(pages, payload, least_bytes), work_dir(pages.sparkSession, "warc")), "warc-archives")


def resolved(headers: DataFrame, max_broadcast: int = 500_000) -> DataFrame:
    """``headers`` with ``refers_to``, and each revisit's ``payload_bytes``, from the original response of its digest.

    The original is the response with the largest page_id.  A revisit without a
    response has nulls for both.  Only digests that have revisits are joined: one
    row each, broadcast under ``max_broadcast``, else split where they are skewed.
    """
    response = F.col("record_type") == "response"
    by_digest = headers.groupBy(F.col("payload_digest").alias("o_digest")).agg(
        F.max(F.when(response, F.col("page_id"))).alias("original"), F.max("payload_bytes").alias("o_bytes"), F.max(~response).alias("revisited")
    )
    originals = small_or_plain(staged(by_digest.where("revisited").drop("revisited"), "warc-originals"), max_broadcast, "o_digest")
    joined = headers.join(originals, ~response & (F.col("payload_digest") == F.col("o_digest")), "left")
    return joined.select("page_id", "url", F.coalesce("payload_bytes", "o_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.when(~response, F.col("original")).alias("refers_to"), "record_id")


def round_trip(pages: DataFrame, payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """One row per page, read back from the archives and resolved; see ``with_revisits`` for nulls and ties."""
    archives = archive_pages(pages, payload, least_bytes)
    n = max(1, min(archives.count(), 10_000))
    return resolved(staged(read_archives(archives.repartition(n)), "warc-headers"))
