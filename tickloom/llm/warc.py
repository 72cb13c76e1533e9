"""WARC archives: write pages as records, read archives back and reassemble segments.

Writing. One ``response`` record per page, its block an HTTP answer in chunked framing. A
payload that was stored already becomes a ``revisit`` record, which names the record it
repeats. A block longer than ``segment_bytes`` is cut: the first part keeps the record's type,
the rest are ``continuation`` records with the origin's identifier and a segment number, the
last with the total length. Spark's text writer stores the records (the blank lines that end a
record are its line end), compressed with gzip, so a lost task is written again as a whole.

Reading. Spark's text reader splits an archive at the blank lines before a version line. That
text may also stand inside a page, so a record goes on until its Content-Length is met; gzip
files aren't split, hence each is read in order by one task, one record at a time. Segments
meet by origin identifier, are put in order, checked against the total length and the digest,
and their chunked framing is decoded. A record is no larger than one page.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import shared_folder

from .common import parts, ship, stage

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1_000
#: Groups of equal payloads that are looked up in memory, largest first. No other group holds
#: more than a thousandth of the pages, so the join for those has no hot key.
HOT_GROUPS = 1_000
FILE_RECORDS = 100_000

# Fixed values of the WARC 1.1 and HTTP 1.1 formats.
VERSION = b"WARC/1.1"
RECORD_END = "\r\n\r\n"
RECORD_BREAK = "\r\n\r\nWARC/"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_PAGE_ID = "urn:page:"
_FIELDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("origin", pa.string()),
        ("number", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("problem", pa.string()),
    ]
)
_COLUMNS = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, origin string, number bigint, total bigint, block binary, "
    "payload binary, payload_bytes bigint, problem string"
)
_DECODED = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload",
            "payload_bytes", "problem")


# Writing ----------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP chunked framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in fields)]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def _records(row: dict, unique: str, date: str, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page; ``unique`` tells apart records that nothing refers to."""
    name = _PAGE_ID + quote(row["page"] or "", safe="") + ("" if row["named"] else f":{unique}")
    revisit = row["record_type"] == "revisit"
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(row["url"] or "", safe="%/:?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", HTTP_TYPE),
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        target = _PAGE_ID + quote(row["first"] or "", safe="")
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{target}>")]
        yield _record(fields, http + b"Content-Length: %d\r\n\r\n" % len(row["payload"]))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(row["payload"])
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record([*fields, ("WARC-Segment-Number", "1")], pieces[0])
    for number, piece in enumerate(pieces[1:], start=2):
        more = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<{name};segment={number}>"),
            ("WARC-Date", date),
            ("WARC-Segment-Origin-ID", f"<{name}>"),
            ("WARC-Segment-Number", str(number)),
        ]
        if number == len(pieces):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(more, piece)


def _writer(date: str, segment_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for rows in parts(batches, 200):
            out = []
            for row in rows.to_pylist():
                out += _records(row, f"{task}.{number}", date, segment_bytes)
                number += 1
            yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    return write


def _equal_payloads(pages: DataFrame, key: Column, least: int) -> DataFrame:
    """key, first (largest page_id of the payload) and times (rows with it) of every payload
    of ``least`` bytes or more that stands in several rows; n is the number of rows."""
    long = pages.where(F.octet_length("html") >= least).select(key.alias("key"), "page_id")
    rows = long.groupBy("key", "page_id").agg(F.count(F.lit(1)).alias("c"))
    found = rows.groupBy("key").agg(
        F.max(F.struct("page_id", "c")).alias("top"), F.sum("c").alias("n")
    )
    found = found.where("n > 1").select("key", F.col("top.page_id").alias("first"), F.col("top.c").alias("times"), "n")
    return stage(found, "payloads")


def classify(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page, url, payload, digest, record_type, first (page a revisit refers to) and named.

    ``pages`` has page_id, url and html. A null html is an empty payload. Of equal payloads of at
    least ``least`` bytes the row with the largest page_id is the response, the others revisit
    it; null ids come before any other. Repeated rows: all rows with that largest id are
    responses. ``named``: other records refer to this one.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    key = F.unhex(F.sha2(F.col("html").cast("binary"), 256))
    groups = _equal_payloads(pages, key, least)
    hot = groups.orderBy(F.desc("n"), "key").limit(HOT_GROUPS)
    hot = stage(hot.select("key", "first", "times"), "hot_payloads")
    rest = groups.join(F.broadcast(hot.select("key")), "key", "left_anti").select("key", "first", "times")
    rows = pages.select("page_id", "url", payload.alias("payload"), key.alias("key"))

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select("key", F.struct(F.col("first").alias("page"), "times").alias(name))

    rows = rows.join(F.broadcast(named(hot, "hot")), "key", "left")
    # Rows with nothing left to look up are dealt by page: 8 bytes equal no digest.
    open_ = F.col("hot").isNull() & (F.octet_length("payload") >= least)
    by_page = F.unhex(F.hex(F.xxhash64("page_id", "url")))
    rows = rows.withColumn("key", F.when(open_, F.col("key")).otherwise(by_page))
    rows = rows.join(named(rest, "rest"), "key", "left")
    group = F.coalesce("hot", "rest")
    first = group["page"]
    repeats = group.isNotNull() & (F.octet_length("payload") >= least)
    kept = F.col("page_id").eqNullSafe(first)
    return rows.select(
        F.col("page_id").cast("string").alias("page"),
        F.col("url").cast("string").alias("url"),
        "payload",
        F.sha1("payload").alias("digest"),
        F.when(repeats & ~kept, "revisit").otherwise("response").alias("record_type"),
        F.when(repeats & ~kept, first.cast("string")).alias("first"),
        (repeats & kept & (group["times"] == 1)).alias("named"),
    )


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    least: int = REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Archive ``pages`` (page_id, url, html; other columns are ignored) as gzip files below
    ``path``, one record per row and its continuations. No page gives no record."""
    ship(pages.sparkSession)
    records = classify(pages, least).mapInArrow(_writer(date, segment_bytes), "record binary")
    (
        # The bytes are kept as they are; text is only the writer's name for them.
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )
    return path


# Reading ----------------------------------------------------------------------------


@dataclass
class Record:
    """A record under way: its header once complete, and its bytes so far."""

    raw: bytearray = field(default_factory=bytearray)
    head: dict[str, str] | None = None
    start: int = 0
    length: int = 0
    problem: str | None = None

    def add(self, data: bytes) -> None:
        self.raw += data
        if self.head is None and (end := self.raw.find(b"\r\n\r\n")) >= 0:
            lines = self.raw[:end].decode("utf-8", "replace").split("\r\n")[1:]
            pairs = (line.partition(":") for line in lines)
            self.head = {name.strip().lower(): value.strip() for name, _, value in pairs}
            self.start = end + 4
            length = self.head.get("content-length", "")
            self.length = int(length) if re.fullmatch("[0-9]{1,18}", length) else 0
            if not length.isdigit():
                self.problem = "no content length"

    @property
    def complete(self) -> bool:
        return self.head is not None and len(self.raw) - self.start >= self.length

    def row(self) -> dict:
        head = self.head or {}
        problem = self.problem or (None if self.complete else "truncated record")

        def number(name: str) -> int | None:
            value = head.get(name, "")
            return int(value) if re.fullmatch("[0-9]{1,18}", value) else None

        def uri(name: str) -> str | None:
            return head[name].strip("<>") if name in head else None

        row = {
            "record_id": uri("warc-record-id"),
            "record_type": head.get("warc-type"),
            "target_uri": head.get("warc-target-uri"),
            "refers_to": uri("warc-refers-to"),
            "payload_digest": _hex_digest(head.get("warc-payload-digest")),
            "origin": uri("warc-segment-origin-id"),
            "number": number("warc-segment-number"),
            "total": number("warc-segment-total-length"),
            "block": bytes(self.raw[self.start : self.start + self.length]),
            "payload": None,
            "payload_bytes": None,
            "problem": problem,
        }
        if row["number"] is None:
            decode(row)
        return row


def _hex_digest(value: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` digest in base 32 or hex; others as they stand."""
    kind, _, digits = (value or "").partition(":")
    if kind.lower() == "sha1" and re.fullmatch("[A-Za-z2-7]{32}", digits):
        return base64.b32decode(digits.upper()).hex()
    return digits.lower() if kind.lower() == "sha1" else value


def unchunk(body: bytes) -> bytes | None:
    """The content of a body in chunked framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(b"[0-9A-Fa-f]{1,15}", size):
            return None
        length, at = int(size, 16), end + 2
        if length == 0:
            # Trailers, if any, end with a blank line.
            return b"".join(out) if body.endswith(b"\r\n") else None
        if body[at + length : at + length + 2] != b"\r\n":
            return None
        out.append(body[at : at + length])
        at += length + 2


def decode(row: dict) -> None:
    """Fill payload, payload_bytes and problem of a whole response or revisit record."""
    block, row["block"] = row["block"], None
    if row["problem"] or row["record_type"] not in ("response", "revisit"):
        return
    head, found, body = block.partition(b"\r\n\r\n")
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    http = {name.strip().lower(): value.strip().lower() for name, _, value in lines}
    if not found:
        row["problem"] = "no http header"
        return
    length = http.get(b"content-length", b"")
    length = int(length) if re.fullmatch(b"[0-9]{1,18}", length) else None
    if row["record_type"] == "revisit":
        row["payload_bytes"] = length
        return
    if b"chunked" in http.get(b"transfer-encoding", b""):
        body = unchunk(body)
        if body is None:
            row["problem"] = "broken chunks"
            return
    elif length is not None and length != len(body):
        row["problem"] = "content length"
        return
    digest = hashlib.sha1(body).hexdigest()
    if row["payload_digest"] not in (None, digest):
        row["problem"] = "digest"
    row |= {"payload": body, "payload_bytes": len(body), "payload_digest": digest}


def _table(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_FIELDS)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of archives, in file order, to records."""
    file, now = None, None
    for rows in parts(batches, 500):
        out = []
        for path, piece in zip(rows.column("file").to_pylist(), rows.column("piece").to_pylist()):
            if path != file:
                if now is not None:
                    out.append(now.row())
                file, now = path, Record()
                now.add(piece)
            elif now.complete:
                out.append(now.row())
                now = Record()
                now.add(b"WARC/" + piece)
            else:  # the break stood inside the record
                now.add(RECORD_BREAK.encode() + piece)
        if out:
            yield _table(out)
    if now is not None:
        yield _table([now.row()])


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """One record from its segments: numbered from 1 without a hole, of the stated length."""
    group = group.sort_values("number", kind="stable")
    head = group.iloc[0].to_dict()
    numbers = group["number"].astype(int).tolist()
    blocks = dict(zip(numbers, group["block"]))
    same = all(blocks[n] == b for n, b in zip(numbers, group["block"]))
    totals = {int(t) for t in group["total"].dropna()}
    row = {name: head[name] for name in _DECODED if isinstance(head[name], str)}
    row = dict.fromkeys(_FIELDS.names) | row
    row["block"] = b"".join(blocks[n] for n in sorted(blocks))
    problems = group["problem"].dropna().tolist()
    if problems:
        row["problem"] = problems[0]
    elif not same or sorted(blocks) != list(range(1, len(blocks) + 1)) or len(totals) != 1:
        row["problem"] = "missing segments"
    elif totals != {len(row["block"])}:
        row["problem"] = "total length"
    decode(row)
    return pd.DataFrame([{name: row[name] for name in _DECODED}])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, target_uri, refers_to, payload_digest, payload, payload_bytes and
    problem of every record in the gzip archives at ``path``, segments put together.

    payload is null for records other than ``response``; a revisit's payload_bytes is what its
    HTTP header states. ``problem`` is null for a sound record; else it names the fault
    (``truncated record``, ``no content length``, ``missing segments``, ``total length``, ``no
    http header``, ``content length``, ``broken chunks``, ``digest``) and nothing is dropped. A
    segment that is stored twice with the same bytes counts once. No file gives an error of
    Spark's reader, an empty file no record.
    """
    ship(spark)
    pieces = (
        spark.read.option("lineSep", RECORD_BREAK)
        .option("pathGlobFilter", "*.gz")
        .schema("value string")
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    )
    records = stage(pieces.mapInArrow(_scan, _COLUMNS), "records")
    whole = records.where("number IS NULL").select(*_DECODED)
    origin = F.coalesce("origin", "record_id")
    segments = records.where("number IS NOT NULL").withColumn("origin", origin)
    joined = segments.groupBy("origin").applyInPandas(_joined, whole.schema)
    return whole.unionByName(joined)


def page_of(uri: str) -> Column:
    """The page id in a record id that ``write_warc`` made; null for a page without one."""
    found = F.regexp_extract(F.col(uri), f"^{_PAGE_ID}([^:;]*)", 1)
    return F.nullif(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), F.lit(""))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages``, read the archives back, and return their facts per page.

    A record that does not come back whole fails the query.
    """
    spark = pages.sparkSession
    path = write_warc(pages, shared_folder(spark, "warc"), **options)
    kind = pages.schema["page_id"].dataType
    sound = F.when(
        F.col("problem").isNotNull(),
        F.raise_error(F.concat_ws(" ", F.lit("record"), "record_id", "problem")).cast("string"),
    ).otherwise(F.col("record_type"))
    return read_warc(spark, path).select(
        page_of("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        sound.alias("record_type"),
        page_of("refers_to").cast(kind).alias("refers_to"),
    )


SQL = f"""
SELECT page_id, bytes AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN bytes >= {REVISIT_BYTES} AND page_id < last THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN bytes >= {REVISIT_BYTES} AND page_id < last THEN last END AS refers_to
FROM (
    SELECT page_id, payload, strlen(payload)::BIGINT AS bytes,
        max(page_id) OVER (PARTITION BY payload) AS last
    FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages)
)
"""
