"""WARC archives: written with an index of byte ranges, read back by coalesced ranges of that index.

Every task writes its own archive (one gzip member for each record) straight to the shared
store through pyarrow's file systems and returns the index rows of what it wrote. A task that is run
again writes another file; only files named by the committed index are ever read, so a lost
executor leaves at most an unread file behind.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import parts
from allelon.storage import new_path, store

INDEX_SCHEMA = "file string, offset long, length long, url string, digest string, record_id string, record_type string"
RECORD_SCHEMA = (
    "record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
_ARROW_INDEX = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_id", pa.string()), ("record_type", pa.string())]
)
_ARROW_RECORD = pa.schema(
    [("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary())]
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"


def _record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header of the full payload and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{record_id}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:record:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _parse(member: bytes) -> tuple:
    """(record id, url, type, refers to, payload bytes, digest, payload or None) of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    named, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    own_id = fields["WARC-Record-ID"][len("<urn:record:") : -1]
    refers = fields["WARC-Refers-To"][len("<urn:record:") : -1] if kind == "revisit" else None
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        if (found, len(payload)) != (named, size):
            raise ValueError(f"record {own_id}: its payload does not match its header")
    return own_id, fields.get("WARC-Target-URI"), kind, refers, size, named, payload if kind == "response" else None


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 100,
    level: int = 3,
    max_file_bytes: int = 1 << 30,
) -> DataFrame:
    """Write a record for each row; returns the stored index (file, offset, length, url, digest, record id and type).

    Of the rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the smallest id
    is a response and the others are revisits of it. Null payloads count as empty; null urls are left out
    of the header. Rows that repeat the smallest id are all responses; a row with a null id never is the
    smallest, and is a revisit wherever an equal payload has an id. Other columns of ``pages`` aren't read; payloads of any length are written whole.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("key"), F.col(url_col).alias("url"), F.coalesce(payload_col, F.lit("")).alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    # Counted per map task first, so an often repeated payload costs one row for each task. Stored, so that Spark knows how many
    # repeated payloads there are and sends them to the pages where they are few; else the pages are dealt by digest, short ones at random.
    counted = rows.where(F.col("size") >= min_revisit_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    firsts = store(counted.where("n > 1 AND first IS NOT NULL").select(F.unhex("digest").alias("__key"), "first"), "warc-firsts")
    at_random = F.substring(F.unhex(F.sha1(F.concat_ws(" ", "id", "url", "digest"))), 1, 8)
    marked = rows.withColumn("__key", F.when(F.col("size") >= min_revisit_bytes, F.unhex("digest")).otherwise(at_random)).join(firsts, "__key", "left").select(
        "id", "url", "payload", "digest", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to")
    )
    folder = new_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in parts(batches, "payload"):
            found = []
            for own, url, payload, digest, refers in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None or at >= max_file_bytes:
                    if out is not None:
                        out.close()
                    system.create_dir(base, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = _gzip(_record("" if own is None else own, url, payload.encode(), digest, refers), level)
                out.write(member)
                found.append((f"{folder}/{name}", at, len(member), url, digest, own, "response" if refers is None else "revisit"))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _ARROW_INDEX.types, strict=True)], schema=_ARROW_INDEX)
        if out is not None:
            out.close()

    return store(marked.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def read_archives(index: DataFrame, gap: int = 1 << 16, most: int = 1 << 23, task_bytes: int = 1 << 23) -> DataFrame:
    """The records that ``index`` (or any selection of its rows) names, with their payloads.

    The byte ranges are dealt over tasks by (file, offset) in ranges of about ``task_bytes``, sorted, and those
    of a file that lie within ``gap`` bytes of each other are fetched by one read of at most ``most`` bytes.
    """
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, math.ceil(total / max(task_bytes, total // 20_000 + 1)))
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, pa.NativeFile] = {}

        def fetch(name: str, spans: list[tuple[int, int]]) -> pa.RecordBatch:
            if name not in opened:
                for old in opened.values():
                    old.close()
                opened.clear()
                system, path = fs.FileSystem.from_uri(name)
                opened[name] = system.open_input_file(path)
            start, end = spans[0][0], spans[-1][0] + spans[-1][1]
            data = opened[name].read_at(end - start, start)
            found = [_parse(data[o - start : o - start + n]) for o, n in spans]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _ARROW_RECORD.types, strict=True)], schema=_ARROW_RECORD)

        name, spans = "", []
        for batch in batches:
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if spans and (file != name or offset - (spans[-1][0] + spans[-1][1]) > gap or offset + length - spans[0][0] > most):
                    yield fetch(name, spans)
                    spans = []
                name = file
                spans.append((offset, length))
        if spans:
            yield fetch(name, spans)

    return ordered.mapInArrow(read, RECORD_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive record for each page, then read all of them back by the index.

    A record with an empty id field stands for a null page_id. Empty input gives an empty result.
    """
    records = read_archives(write_archives(pages))
    as_id = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    return records.select(
        as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to")
    )
