"""WARC archives: writing pages as records, reading them back and joining segments.

A page becomes a response record whose payload is sent in chunked transfer
framing. A block longer than the segment size is cut: the first part stays a
response, the others are continuation records that name the first one's id, and
the last states the total length. Of equal payloads, all but the first page are
revisit records without payload.

Archives are ordinary gzip files of records, written by Spark's text writer, one
record a line with the record end as line separator, so they can be in any file
system that Spark reaches. Reading takes one file at a time and streams through
it; only segments of cut records are shuffled, by the id of their origin.

Nulls and odd rows: a null payload is empty, a null URL an empty target, a null
page id is left out of the record and is null again when read. Rows that repeat
a page id give one record each. A record whose segments are missing, doubled
with other contents, of another total length, wrongly framed or of another digest
is returned with a null payload and the reason in `problem`; a file that breaks
off gives its whole records and one row with the reason.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored, utf8

RECORD_END = "\r\n\r\n"
LEAST_REVISIT_BYTES = 100
_VERSION = b"WARC/1.1\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_READ = pa.schema(
    [("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("page_id", pa.int64())]
    + [(n, pa.string()) for n in ("record_type", "digest", "problem")]
    + [("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("data", pa.binary())]
)
_READ_DDL = (
    "origin string, segment long, total long, page_id long, record_type string, digest string, problem string,"
    " refers_to long, payload_bytes long, data binary"
)


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over. ValueError if the framing is wrong."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        head = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            raise ValueError("bad chunk size")
        size, at = int(head, 16), end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("bad chunk end")
        out.append(body[at : at + size])
        at += size + 2
    if body[at : at + 2] != b"\r\n" and b"\r\n\r\n" not in body[at:]:
        raise ValueError("no end of chunks")
    return b"".join(out)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return _VERSION + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def records_of(row: tuple, segment_bytes: int, chunk_bytes: int, date: str) -> Iterator[bytes]:
    """The records of one page: page_id, url, payload, digest, refers_to, row number."""
    page_id, url, payload, digest, refers_to, number = row
    record_id = f"<urn:page:{'' if page_id is None else page_id}:{number}>"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    common = [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = [("WARC-Profile", profile), ("WARC-Refers-To-Page-ID", refers_to), http]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *common, *more], _HTTP + b"\r\n")
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    cuts = range(0, len(block), segment_bytes)
    for k, at in enumerate(cuts, 1):
        own = [("WARC-Segment-Number", k if len(cuts) > 1 else None)]
        if k > 1:
            own += [("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Total-Length", len(block) if k == len(cuts) else None)]
            head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{record_id[:-1]}:{k}>"), ("WARC-Date", date), ("WARC-Target-URI", target)]
        else:
            head = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *common, http]
        yield _record(head + own, block[at : at + segment_bytes])


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to: the page that an equal payload is kept for, null for kept ones.

    Digests that occur more than once are counted first; payloads never meet.
    """
    rows = pages.select("page_id", "url", utf8(F.col("html")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    copies = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
    copies = copies.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    return rows.join(stored(copies, "payload-copies"), "digest", "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def write_archives(
    pages: DataFrame, path: str, segment_bytes: int = 16384, chunk_bytes: int = 4096,
    date: str = "2000-01-01T00:00:00Z", records_per_file: int = 20_000,
) -> None:
    """Write pages (page_id, url, html) as gzipped WARC files below `path`."""

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(batches, "page_id", "url", "payload", "digest", "refers_to", "number")
        records = ((x,) for r in rows for x in records_of(r, segment_bytes, chunk_bytes, date))
        return in_batches(records, pa.schema([("value", pa.binary())]), 200)

    numbered = with_revisits(pages).withColumn("number", F.monotonically_increasing_id())
    text = numbered.mapInArrow(lines, "value binary").select(F.col("value").cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", records_per_file).text(path, compression="gzip", lineSep=RECORD_END)


def _parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record start")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        if len(block := stream.read(size)) < size:
            raise ValueError("record breaks off")
        yield headers, block


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP headers")
    return dechunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head) else body


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?\d+", text) else None


def _checked(block: bytes, stated: str | None) -> tuple[str | None, str | None, int | None, bytes | None]:
    """Digest, problem, length and payload of a whole block."""
    try:
        payload = payload_of(block)
    except ValueError as error:
        return None, str(error), None, None
    digest = hashlib.sha256(payload).hexdigest()
    if stated not in (None, digest):
        return None, "other digest", None, None
    return digest, None, len(payload), payload


def _read_file(content: bytes, with_payload: bool) -> Iterator[tuple]:
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    try:
        for headers, block in _parsed(stream):
            kind, record_id = headers.get("warc-type"), headers.get("warc-record-id")
            stated = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
            page_id, segment = _number(headers.get("warc-page-id")), _number(headers.get("warc-segment-number"))
            if kind == "revisit":
                yield record_id, None, None, page_id, kind, stated, None, _number(headers.get("warc-refers-to-page-id")), None, None
            elif kind == "response" and segment is None:
                digest, problem, size, payload = _checked(block, stated)
                yield record_id, None, None, page_id, kind, digest, problem, None, size, payload if with_payload else None
            elif kind in ("response", "continuation"):
                origin = record_id if kind == "response" else headers.get("warc-segment-origin-id")
                yield origin, segment, _number(headers.get("warc-segment-total-length")), page_id, kind, stated, None, None, None, block
    except (ValueError, KeyError, EOFError, OSError) as error:
        yield None, None, None, None, None, None, f"unreadable: {error}", None, None, None


def joined_segments(parts: list[dict]) -> tuple:
    """One row from the segments of an origin: in order, without gap, of the stated total length."""
    by_number: dict[int, bytes] = {}
    for p in parts:
        if by_number.setdefault(p["segment"], p["data"]) != p["data"]:
            return None, "segments of one number differ", None, None
    if sorted(by_number, key=lambda n: -1 if n is None else n) != list(range(1, len(by_number) + 1)):
        return None, "segment missing", None, None
    block = b"".join(by_number[k] for k in sorted(by_number))
    totals = {p["total"] for p in parts if p["total"] is not None}
    if totals != {len(block)}:
        return None, "other total length", None, None
    return _checked(block, next((p["digest"] for p in parts if p["segment"] == 1), None))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """origin, page_id, record_type, refers_to, payload_digest, payload_bytes, problem and payload of all records below `path`."""
    from_files = lambda batches: in_batches(
        (r for (c,) in rows_of(batches, "content") for r in _read_file(c, with_payload)), _READ, 500
    )
    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(from_files, _READ_DDL)
    part = F.struct("segment", "total", "page_id", "record_type", "digest", "data")
    cut = F.col("segment").isNotNull()
    rest = ["page_id", "record_type", "refers_to", "digest", "payload_bytes", "problem", "data"]
    grouped = found.groupBy(F.coalesce("origin", F.lit("")).alias("origin"), cut.alias("cut")).agg(
        F.collect_list(F.when(cut, part)).alias("parts"), F.collect_list(F.when(~cut, F.struct(*rest))).alias("whole")
    )

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for origin, parts, whole in rows_of(batches, "origin", "parts", "whole"):
                for x in whole:
                    yield origin, *(x[n] for n in rest)
                if parts:
                    digest, problem, size, payload = joined_segments(parts)
                    page_id = next((p["page_id"] for p in parts if p["segment"] == 1), None)
                    yield origin, page_id, "response", None, digest, size, problem, payload if with_payload else None

        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        return in_batches(rows(), pa.schema(list(zip(["origin", *rest], types, strict=True))), 500)

    ddl = "origin string, page_id long, record_type string, refers_to long, digest string, payload_bytes long, problem string, data binary"
    return grouped.mapInArrow(join, ddl).select(
        "origin", "page_id", "record_type", "refers_to", F.col("digest").alias("payload_digest"), "payload_bytes", "problem",
        F.col("data").alias("payload"),
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give revisits the payload length of the response they refer to; a problem if there is none of that digest."""
    kept = records.where("record_type = 'response' AND payload_digest IS NOT NULL")
    kept = kept.groupBy(F.col("page_id").alias("kept_id"), F.col("payload_digest").alias("kept_digest")).agg(F.max("payload_bytes").alias("kept_bytes"))
    kept = stored(kept, "warc-kept")  # a join of two scans, so that a page with very many copies can be split
    same = (F.col("refers_to") == F.col("kept_id")) & (F.col("payload_digest") == F.col("kept_digest"))
    lost = (F.col("record_type") == "revisit") & F.col("kept_bytes").isNull()
    out = records.join(kept, same, "left")
    return out.select(
        *(c for c in records.columns if c not in ("payload_bytes", "problem")),
        F.coalesce("payload_bytes", "kept_bytes").alias("payload_bytes"),
        F.when(lost, "no response of this digest").otherwise(F.col("problem")).alias("problem"),
    )
