"""WARC archives: round trips, and records that are broken."""

import gzip
import hashlib

import pytest

from epiloom.llm import warc

PAGES = [
    (1, "http://a/1", "x" * 500, "clash"), (2, "http://a/2", "x" * 500, "clash"), (3, None, None, None), (4, "http://a/4 b\nc", "é" * 40_000, ""),
    (5, "u", "x" * 99, ""), (6, "u", "x" * 99, ""), (7, "u", "", ""), (1, "http://a/1", "x" * 500, "clash"), (None, "u", "x" * 500, ""),
    (8, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n0\r\n\r\n" * 20, ""),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")


def test_round_trip(spark, tmp_path):
    warc.write_archives(frame(spark, PAGES), str(tmp_path / "w"), segment_bytes=4096, chunk_bytes=1000)
    found = warc.resolve_revisits(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert len(found) == len(PAGES) and not any(r.problem for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.page_id, []).append(r)
    for page_id, _, text, _ in PAGES:
        data = (text or "").encode()
        for r in by_id[page_id]:
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
            assert r.record_type == "revisit" or bytes(r.payload) == data
    assert [(r.record_type, r.refers_to) for r in by_id[1]] == [("response", None)] * 2
    assert [(r.record_type, r.refers_to) for r in by_id[2] + by_id[None]] == [("revisit", 1)] * 2
    assert all(r.record_type == "response" for r in by_id[5] + by_id[6] + by_id[7] + by_id[3])


def test_empty_table(spark, tmp_path):
    warc.write_archives(frame(spark, []), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def test_segments_are_whole_records(spark, tmp_path):
    warc.write_archives(frame(spark, [PAGES[3]]), str(tmp_path / "w"), segment_bytes=10_000)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert raw.count(b"WARC-Type: continuation") == 8 and raw.count(b"WARC-Segment-Total-Length") == 1


def segments(block, cuts):
    edges = [0, *cuts, len(block)]
    parts = [block[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return [
        {"segment": k, "total": len(block) if k == len(parts) else None, "digest": None, "data": p, "page_id": 1, "record_type": ""}
        for k, p in enumerate(parts, 1)
    ]


def test_joined_segments():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"hello world" * 50, 64)
    good = segments(block, [10, 60, 300])
    assert warc.joined_segments(good[::-1])[3] == b"hello world" * 50
    assert warc.joined_segments(good + [good[1]])[1] is None
    assert warc.joined_segments([good[0], good[2], good[3]])[1] == "segment missing"
    assert warc.joined_segments(good[:3])[1] == "other total length"
    assert warc.joined_segments([*good, good[1] | {"data": b"?"}])[1] == "segments of one number differ"
    assert warc.joined_segments([good[0] | {"digest": "00"}, *good[1:]])[1] == "other digest"


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_chunks(size):
    data = bytes(range(256)) * 9
    assert warc.dechunked(warc.chunked(data, size)) == data
    assert warc.dechunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n", b"3\r\nabc\r\n0"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_broken_file(spark, tmp_path):
    warc.write_archives(frame(spark, PAGES[:1]), str(tmp_path / "w"))
    (path,) = [p for p in (tmp_path / "w").glob("*.gz") if len(gzip.decompress(p.read_bytes())) > 10]
    whole = gzip.decompress(path.read_bytes())
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.warc").write_bytes(whole + whole[: len(whole) // 2])
    found = warc.read_archives(spark, str(tmp_path / "b")).collect()
    assert sorted((r.payload_bytes is None, bool(r.problem)) for r in found) == [(False, False), (True, True)]
