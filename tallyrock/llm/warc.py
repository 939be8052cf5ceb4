"""WARC archives of pages in Zstandard, and their reader.

An archive starts with a skippable frame that holds its dictionary, and then has
one Zstandard frame per record. Every task writes archives of its own, each with a
dictionary of its first records, so nothing passes through the driver.

Pages with the same payload have one `response`, that of the largest page_id;
the others are `revisit` records that name it and have no payload. A NULL html
is an empty payload; empty payloads of at least `min_revisit_bytes` = 0 bytes
count like others. A NULL page_id is smaller than any other; of rows that tie
for the largest, one is the response. Its header is left out, as is that of a
NULL url. Very long pages are one record each. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.llm.common import read
from tallyrock.session import scratch_path

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
BREAK = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2000-01-01T00:00:00Z"  # of every record: the pages table has no time of capture
DICTIONARY_BYTES = 32 * 1024
SAMPLE_BYTES = 2 * 1024 * 1024  # of first records, from which a dictionary is made
ARCHIVE_BYTES = 64 * 1024 * 1024  # after which a task starts a new archive
READ_BYTES = 1024 * 1024
READ_TASKS = 100_000  # of at least one archive each

Record = tuple[dict[str, str], bytes]


def base32(sha: bytes) -> str:
    return base64.b32encode(sha).decode()


def digest(payload: bytes) -> str:
    return base32(hashlib.sha1(payload).digest())


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), b"Content-Length: %d" % len(block)]
    return BREAK.join(lines) + BREAK * 2 + block + BREAK * 2


def header_value(text: str) -> str:
    """Text without line breaks and outer blanks, as a header can hold it."""
    return " ".join(text.split())


def page_record(page_id, url, html, sha, size, kind, refers_to) -> Record:
    """The record of a page; of a revisit only the digest and size of its payload are needed."""
    payload = (html or "").encode("utf-8")
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {kind}')}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{base32(sha)}",
        "X-Payload-Length": str(size),
    }
    if url is not None:
        headers["WARC-Target-URI"] = header_value(url)
    if page_id is not None:
        headers["X-Page-Id"] = str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kind == "response":
        headers["Content-Type"] = "application/http; msgtype=response"
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        headers["WARC-Profile"] = REVISIT_PROFILE
        if refers_to is not None:
            headers["X-Refers-To-Page-Id"] = str(refers_to)
        block = b""
    headers["WARC-Block-Digest"] = f"sha1:{digest(block)}"
    return headers, block


def make_dictionary(samples: list[bytes]) -> bytes:
    """Trained on the first records; where there are too few, the records themselves."""
    joined = b"".join(samples)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return joined[-DICTIONARY_BYTES:]


class ArchiveWriter:
    """Writes records into one archive after the other; an archive gets its name when it is whole."""

    def __init__(self, folder: str, name: str):
        self.files, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.root, recursive=True)
        self.name, self.number, self.out, self.held, self.done = name, 0, None, [], []

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.held.append(raw)
            if sum(map(len, self.held)) >= SAMPLE_BYTES:
                self.open()
        else:
            self.write(raw)

    def open(self) -> None:
        raw = make_dictionary(self.held)
        self.codec = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw))
        self.part = f"{self.root}/.{self.name}-{self.number:05d}-{uuid.uuid4().hex}"
        self.out, self.records, self.bytes = self.files.open_output_stream(self.part, compression=None), 0, 0
        held = zstandard.ZstdCompressor(level=3).compress(raw)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(held)) + held)
        waiting, self.held = self.held, []
        for record in waiting:
            self.write(record)

    def write(self, raw: bytes) -> None:
        frame = self.codec.compress(raw)
        self.out.write(frame)
        self.records, self.bytes = self.records + 1, self.bytes + len(frame)
        if self.bytes >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.held:
            self.open()
        if self.out is not None:
            self.out.close()
            path = f"{self.root}/{self.name}-{self.number:05d}.warc.zst"
            self.files.move(self.part, path)  # a repeated task replaces the file with the same records
            self.done.append((path, self.records))
            self.out, self.number = None, self.number + 1


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page under `folder`; returns the written list of (path, records).

    `pages` is as `with_record_types` gives it.
    """
    columns = ["page_id", "url", "html", "sha", "bytes", "record_type", "refers_to"]

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, f"part-{TaskContext.get().partitionId():06d}")
        for part in parts:
            for start in range(0, part.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in part.slice(start, 256).columns)):
                    writer.add(record_bytes(*page_record(*row)))
        writer.close()
        if writer.done:
            names, counts = zip(*writer.done)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64())], ["path", "records"])

    listing = f"{folder}/list"
    pages.select(*columns).mapInArrow(write, "path string, records long").write.parquet(listing)
    return pages.sparkSession.read.schema("path string, records long").parquet(listing)


def with_record_types(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """The pages with the SHA-1 and size of their payload, record_type and refers_to.

    Only digests and ids are grouped; pages meet their group's answer in a join, which Spark can
    split where one payload has very many copies.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html").withColumns(
        {"sha": F.unhex(F.sha1(payload)), "bytes": F.octet_length(payload), "row": F.monotonically_increasing_id()}
    )
    groups = rows.groupBy("sha").agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("copies"))
    copied = groups.where("copies > 1").select("sha", "first")
    known = rows.join(copied, "sha", "left")
    revisit = (
        F.col("first").isNotNull()
        & (F.col("bytes") >= min_revisit_bytes)
        & ~(F.struct("page_id", "row").eqNullSafe(F.col("first")))
    )
    return known.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("html")).alias("html"),
        F.col("sha"),
        "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
    )


def frames(stream) -> Iterator[bytes]:
    """The decoded frames of an archive, whose first frame must hold the dictionary."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    raw = stream.read(struct.unpack("<I", head[4:])[0])
    if raw.startswith(FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    rest = b""
    while rest or (rest := stream.read(READ_BYTES)):
        one, parts = decoder.decompressobj(), []
        while not one.eof:
            if not rest and not (rest := stream.read(READ_BYTES)):
                raise ValueError("the archive ends inside a frame")
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


def parse_record(raw: bytes) -> Record:
    """Headers and block of a record; ValueError where anything is not as the format says."""
    head, found, rest = raw.partition(BREAK * 2)
    first, *lines = head.split(BREAK)
    if not found or first != VERSION:
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or name in headers:
            raise ValueError(f"bad header {name}")
        headers[name] = value.strip()
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} - set(headers)
    if missing:
        raise ValueError(f"no {', '.join(sorted(missing))}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != BREAK * 2:
        raise ValueError("the block is not as long as its header says")
    block = rest[:length]
    if headers.get("WARC-Block-Digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("the block does not have its digest")
    return headers, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes | None:
    """The payload of a response, checked; None for a record without one."""
    if headers["WARC-Type"] != "response":
        return None
    head, found, payload = block.partition(BREAK * 2)
    lengths = [int(x.split(b":")[1]) for x in head.split(BREAK) if x.lower().startswith(b"content-length:")]
    if not found or lengths != [len(payload)]:
        raise ValueError("the payload is not as long as its header says")
    if headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
        raise ValueError("the payload does not have its digest")
    return payload


RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string,"
    " payload_bytes long, payload binary"
)


def read_archives(listing: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of the listed archives, read as streams; a damaged archive fails the job."""

    def rows(paths: list[dict]) -> Iterator[tuple]:
        files, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for path in paths:
            count, expected = 0, path["records"]
            with files.open_input_stream(path["path"], compression=None) as stream:
                for raw in frames(stream):
                    headers, block = parse_record(raw)
                    payload = payload_of(headers, block)
                    size = int(headers["X-Payload-Length"])
                    if payload is not None and len(payload) != size:
                        raise ValueError("the payload is not as long as its header says")
                    number = [int(headers[k]) if k in headers else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                    yield (number[0], headers.get("WARC-Target-URI"), headers["WARC-Type"], number[1],
                           headers["WARC-Payload-Digest"].removeprefix("sha1:"), size,
                           payload if payloads else None)
                    count += 1
            if count != expected:
                raise ValueError(f"{path['path']} has {count} records, not {expected}")

    def load(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held, size = [], 0
            for row in rows(part.to_pylist()):
                held.append(row)
                size += 100 + (row[5] if payloads else 0)
                if size > 4 * READ_BYTES:
                    yield batch(held)
                    held, size = [], 0
            yield batch(held)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
        i, s = pa.int64(), pa.string()
        columns = list(zip(*held)) or [()] * 7
        kinds = (i, s, s, i, s, i, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    # An explicit number: Spark would else size tasks by the bytes of the paths, and read all in one.
    tasks = max(1, min(READ_TASKS, listing.count()))
    return listing.repartition(tasks).mapInArrow(load, RECORD_SCHEMA)


def op2_warc_zstd(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    listing = write_archives(with_record_types(read(spark, folder, "pages", "page_id", "url", "html")), archives)
    return read_archives(listing, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP2_SQL = """
WITH digests AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS first FROM digests)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
    ((((instr('0123456789abcdef', substr(sha, CAST(5 * i // 4 + 1 AS BIGINT), 1)) - 1) * 16
       + instr('0123456789abcdef', substr(sha, CAST(5 * i // 4 + 2 AS BIGINT), 1)) - 1) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31) AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
