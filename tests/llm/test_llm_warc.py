import base64
import hashlib
import io
import random
import struct
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyrock.llm import warc
from tallyrock.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def written(spark, rows):
    folder = scratch_path(spark, "warc-test")
    listing = warc.write_archives(warc.with_record_types(spark.createDataFrame(rows, SCHEMA)), folder)
    return listing, folder


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_with_odd_rows(spark):
    long = "é" * 3_000_000
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, None, None), (4, "u4", ""), (None, "u5", "same"),
            (6, "a\r\nb", "own"), (7, "u7", long), (8, "u8", "tie"), (8, "u8", "tie")]
    listing, folder = written(spark, rows)
    found = warc.read_archives(listing, folder).collect()
    got = Counter((r["page_id"], r["payload_digest"], r["payload_bytes"]) for r in found)
    assert got == Counter((i, digest(h), len((h or "").encode())) for i, _, h in rows)
    kinds = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found), key=str)
    assert kinds == sorted(
        [(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (0, "revisit", 2),
         (6, "response", None), (7, "response", None), (8, "response", None), (8, "revisit", 8)], key=str
    )
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in found if r["record_type"] == "response"}
    assert texts[7] == long and texts[6] == "own" and texts[4] == ""
    assert {r["url"] for r in found if r["page_id"] == 6} == {"a b"}


def test_an_empty_table_gives_no_records(spark):
    assert warc.read_archives(*written(spark, [])).count() == 0


def test_small_payloads_may_all_be_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], SCHEMA)
    types = {r["page_id"]: r["record_type"] for r in warc.with_record_types(pages, min_revisit_bytes=3).collect()}
    assert types == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def archive(records, dictionary=None):
    random.seed(5)
    dictionary = dictionary or bytes(random.randrange(256) for _ in range(2000))
    codec = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    head = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(dictionary)) + dictionary
    return head + b"".join(map(codec.compress, records))


def record(**changes):
    headers, block = warc.page_record(5, "u", "text", hashlib.sha1(b"text").digest(), 4, "response", None)
    return warc.record_bytes(headers | changes, block)


def test_frames_use_the_dictionary_of_the_leading_frame():
    assert list(warc.frames(io.BytesIO(archive([b"one", b"two" * 9999])))) == [b"one", b"two" * 9999]
    with pytest.raises(ValueError, match="dictionary frame"):
        list(warc.frames(io.BytesIO(b"plain")))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.frames(io.BytesIO(archive([b"x" * 5000])[:-3])))


def test_records_are_validated():
    headers, block = warc.parse_record(record())
    assert warc.payload_of(headers, block) == b"text"
    bad = {
        "not a WARC record": record().replace(b"WARC/1.1", b"WARC/9"),
        "no WARC-Date": record().replace(b"WARC-Date", b"X-Date"),
        "as long as": record().replace(b"Content-Length: 7", b"Content-Length: 8"),
        "its digest": record().replace(b"text\r\n\r\n", b"tixt\r\n\r\n"),
    }
    for message, raw in bad.items():
        with pytest.raises(ValueError, match=message):
            warc.payload_of(*warc.parse_record(raw + b"x" * (message == "as long as")))


def test_archives_are_read_by_many_tasks(spark):
    rows = spark.createDataFrame([(k, f"u{k}", f"text {k}" * 50) for k in range(600)], SCHEMA)
    folder = scratch_path(spark, "warc-test")
    listing = warc.write_archives(warc.with_record_types(rows).repartition(60), folder)
    assert listing.count() == 60
    found = warc.read_archives(listing, folder)
    tasks = found.select(F.spark_partition_id().alias("task"), "page_id").collect()
    # They are dealt in turn from where each writing task happens to start.
    assert len(tasks) == 600 and 30 < len({r["task"] for r in tasks}) <= 60
