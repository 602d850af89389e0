import base64
import gzip
import hashlib
import io
import random
import uuid
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakework.llm import warc
from tests.llm.conftest import as_rows, with_clashes

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(n=120, seed=3):
    rng = random.Random(seed)
    pool = [None, "", "a", "é\r\n\r\nWARC/1.1\r\n", "x" * 5000] + ["p%d" % rng.randrange(40) for _ in range(30)]
    return [(i, f"http://h/{i}\r\nx" if i % 9 else None, rng.choice(pool)) for i in range(n)]


def brute(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        original = max(same, default=None)
        revisit = len(data) >= least and original is not None and i != original
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 2, 10_000])
def test_round_trip_equals_brute_force(spark, least):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    assert as_rows(warc.round_trip(df, least_bytes=least), *COLUMNS) == brute(rows, least)


def test_archives_on_disk(spark):
    rows = pages(40) + [(7, "http://again", "p1")] * 3
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    before = datetime.now(UTC).replace(microsecond=0)
    archives = warc.archive_pages(df).collect()
    assert sum(a.records for a in archives) == len(rows)
    records = [warc.parse_record(m) for a in archives for m in warc.read_members(io.BytesIO(Path(a.archive.removeprefix("file://")).read_bytes()), 7)]
    by_digest = {r["payload_digest"]: r for r in records if r["record_type"] == "response"}
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert sorted((r["page_id"], r["payload_digest"]) for r in records) == sorted((i, digest(h)) for i, _, h in rows)
    assert all(digest(r["payload"].decode()) == r["payload_digest"] for r in by_digest.values())
    assert len({r["record_id"] for r in records}) == len(rows)
    for r in records:
        assert before <= datetime.fromisoformat(r["fields"]["WARC-Date"]) <= datetime.now(UTC)
        if r["record_type"] == "revisit":
            original = by_digest[r["payload_digest"]]
            assert r["payload"] is None and r["fields"]["WARC-Refers-To-Target-URI"] == original["url"] and r["fields"]["WARC-Refers-To-Date"] == original["fields"]["WARC-Date"]


def test_records_are_checked():
    sha1 = hashlib.sha1(b"abc").digest()
    member = gzip.decompress(warc.record(1, "u", b"abc", sha1, uuid.uuid4(), "2020-02-02T02:02:02Z"))
    assert warc.parse_record(member)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(member.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="length"):
        warc.parse_record(member[:-1])
    with pytest.raises(ValueError, match="not a WARC"):
        warc.parse_record(b"HTTP/1.1 200\r\n\r\n")


def test_revisits_are_resolved_by_digest(spark):
    """Headers alone say what a revisit refers to, in whatever archive its original is."""
    rows = [(9, "u", 3, "D", "response", "a"), (2, "v", None, "D", "revisit", "b"), (4, "w", None, "lost", "revisit", "c"), (5, "x", 1, "E", "response", "d"), (6, "y", 1, "E", "response", "e")]
    for most in (0, 100):
        got = warc.resolved(spark.createDataFrame(rows, warc.HEADERS), most)
        assert as_rows(got, "page_id", "payload_bytes", "refers_to") == as_rows(spark.createDataFrame([(9, 3, None), (2, 3, 9), (4, None, None), (5, 1, None), (6, 1, None)], "a int, b int, c int"))


def test_a_payload_of_nine_tenths_of_the_pages(spark):
    rows = [(i, f"u{i}", "same" if i % 10 else f"p{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(8)
    assert as_rows(warc.round_trip(df), *COLUMNS) == brute(rows)
    joined = as_rows(warc.with_revisits(df, max_broadcast=0), "page_id", "revisit", "original_url")
    assert joined == as_rows(warc.with_revisits(df), "page_id", "revisit", "original_url") and sum(r[1] for r in joined) == 359


def test_edges(spark):
    rows = [(5, "u", "x"), (5, "u", "x"), (4, "u", "x"), (None, None, "x"), (None, None, "only nulls"), (None, None, "only nulls")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert as_rows(warc.round_trip(df), *COLUMNS) == brute(rows)
    assert as_rows(warc.round_trip(with_clashes(df)), *COLUMNS) == brute(rows)
    assert warc.round_trip(df.limit(0)).count() == 0
    assert as_rows(warc.round_trip(df.drop("url")), *COLUMNS) == brute(rows)
    assert warc.round_trip(df.withColumn("html", F.col("html").cast("binary"))).count() == len(rows)
