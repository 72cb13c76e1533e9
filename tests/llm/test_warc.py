import gzip
import hashlib
import random

import pytest

from checks.compare import connect, differences
from tests.conftest import SMALL
from tickloom.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string, payload string, key string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "k", "d") for r in rows], SCHEMA)


def brute(rows):
    last = {}
    for page, _, html in rows:
        text = html or ""
        if text not in last or last[text] is None or (page is not None and page > last[text]):
            last[text] = page
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and page != last[html or ""]
        kind = "revisit" if revisit else "response"
        first = last[html] if revisit else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, first))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def text(seed, n):
    r = random.Random(seed)
    return "".join(r.choice("abc <é🙂\r\n") for _ in range(n))


ROWS = [
    (1, "http://a", "x" * 999), (2, "http://b", "x" * 999), (3, "u", "y" * 1000), (4, None, "y" * 1000),
    (5, "http://c/\r\nWARC-Type: x", None), (6, "", ""), (7, "é ü", text(7, 400)),
    (8, "big", text(8, 90_000)), (9, "big", text(8, 90_000)), (9, "big", text(8, 90_000)),
    (None, "n", "y" * 1000), (None, "n", text(10, 3000)), (None, "n", text(10, 3000)),
    (11, "in", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 700),
    (12, "end", "z" * 4000 + "\r\n\r\n"), (13, "end", "\r\n\r\nWARC/"), (14, "t", text(14, 500)), (14, "t", text(14, 500)),
]


@pytest.mark.parametrize("segment_bytes", [64, 1000, 16_384])
def test_round_trip_equals_brute_force(spark, segment_bytes):
    assert got(warc.round_trip(pages(spark, ROWS), segment_bytes=segment_bytes)) == brute(ROWS)


def test_one_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_GROUPS", 1)
    rows = [(k, "u", "copy " * 300) for k in range(40)]
    rows += [(100 + k, "u", f"pair {k // 2} " * 200) for k in range(20)]
    assert got(warc.round_trip(pages(spark, rows))) == brute(rows)


def test_no_pages(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []


def archive(path, *records, members=True):
    path.mkdir(parents=True)
    data = [r + b"\r\n\r\n" for r in records]
    with open(path / "a.warc.gz", "wb") as out:
        for part in data if members else [b"".join(data)]:
            out.write(gzip.compress(part))
    return str(path)


def record(kind, name, block, *more):
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *fields]).encode() + b"\r\n\r\n" + block


def http(body, *more):
    return "\r\n".join(["HTTP/1.1 200 OK", *more]).encode() + b"\r\n\r\n" + body


def read(spark, path):
    return {r.record_id: r for r in warc.read_warc(spark, path).collect()}


@pytest.mark.parametrize("members", [True, False])
def test_archives_of_others(spark, tmp_path, members):
    """Records per gzip member or all in one, segments out of order, other record types."""
    whole = http(warc.chunked(b"payload " * 40, 7), "transfer-encoding:  Chunked")
    cuts = [whole[:50], whole[50:90], whole[90:]]
    origin = "WARC-Segment-Origin-ID: <o>"
    path = archive(
        tmp_path / "w",
        record("warcinfo", "i", b"software: x\r\n"),
        record("continuation", "o3", cuts[2], origin, "WARC-Segment-Number: 3",
               f"WARC-Segment-Total-Length: {len(whole)}"),
        record("response", "o", cuts[0], "WARC-Segment-Number: 1", "WARC-Target-URI: http://x"),
        record("continuation", "o2", cuts[1], origin, "WARC-Segment-Number: 2"),
        record("continuation", "o2", cuts[1], origin, "WARC-Segment-Number: 2"),
        record("response", "plain", http(b"abc", "Content-Length: 3")),
        record("response", "ext", http(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n", "Transfer-Encoding: chunked")),
        record("response", "digest", http(b"abc"), "WARC-Payload-Digest: sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5"),
        record("revisit", "r", http(b"", "Content-Length: 9"), "WARC-Refers-To: <o>"),
        members=members,
    )
    found = read(spark, path)
    assert {name for name, r in found.items() if r.problem} == set()
    assert found["o"].payload == b"payload " * 40 and found["o"].target_uri == "http://x"
    assert found["plain"].payload == found["ext"].payload == found["digest"].payload == b"abc"
    assert found["r"].refers_to == "o" and found["r"].payload is None and found["r"].payload_bytes == 9
    assert found["i"].payload is None and len(found) == 6


def test_damaged_records_are_named(spark, tmp_path):
    origin = "WARC-Segment-Origin-ID: <{}>"
    first = ("WARC-Segment-Number: 1",)
    path = archive(
        tmp_path / "w",
        record("response", "hole", b"HTTP/1.1 200 OK\r\n\r\n", *first),
        record("continuation", "h3", b"x", origin.format("hole"), "WARC-Segment-Number: 3", "WARC-Segment-Total-Length: 20"),
        record("response", "noend", b"HTTP/1.1 200 OK\r\n\r\n", *first),
        record("response", "long", b"HTTP/1.1 200 OK\r\n\r\n", *first),
        record("continuation", "l2", b"xy", origin.format("long"), "WARC-Segment-Number: 2", "WARC-Segment-Total-Length: 20"),
        record("response", "two", b"HTTP/1.1 200 OK\r\n\r\n", *first),
        record("continuation", "t2", b"x", origin.format("two"), "WARC-Segment-Number: 2", "WARC-Segment-Total-Length: 20"),
        record("continuation", "t2", b"y", origin.format("two"), "WARC-Segment-Number: 2"),
        record("response", "chunks", http(b"5\r\nabc", "Transfer-Encoding: chunked")),
        record("response", "length", http(b"abc", "Content-Length: 4")),
        record("response", "digest", http(b"abc"), "WARC-Payload-Digest: sha1:" + "0" * 40),
        record("response", "header", b"no header"),
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <nolength>\r\n\r\n",
        record("response", "cut", b"HTTP/1.1")[:-5],
    )
    assert {name: r.problem for name, r in read(spark, path).items()} == {
        "hole": "missing segments",
        "noend": "missing segments",
        "long": "total length",
        "two": "missing segments",
        "chunks": "broken chunks",
        "length": "content length",
        "digest": "digest",
        "header": "no http header",
        "nolength": "no content length",
        "cut": "truncated record",
    }


def test_a_record_that_comes_back_damaged_fails_the_query(spark, tmp_path, monkeypatch):
    path = archive(tmp_path / "w", record("response", "urn:page:1", http(b"5\r\nabc", "Transfer-Encoding: chunked")))
    monkeypatch.setattr(warc, "write_warc", lambda *_, **__: path)
    with pytest.raises(Exception, match="broken chunks"):
        warc.round_trip(pages(spark, [(1, "u", "x")])).collect()


def test_query_equals_its_sql(spark):
    found = queries.op12_warc(spark, SMALL).toPandas()
    want = connect(SMALL).sql(queries.sql_texts()["op12_warc"]).df()
    assert differences(found, want) == ""
