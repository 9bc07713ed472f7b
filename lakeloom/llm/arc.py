"""Converter of legacy ARC archives to WARC.

An ARC file starts with a ``filedesc`` record whose body names the version: version 1 headers are
``URL IP date type length``, version 2 adds result code, checksum, location, offset and file name
before the length. Bodies are found by their declared length only. Each record becomes a WARC
record with a synthesised identifier (a name-based UUID, so a repeated task gives the same one),
the date in ISO form, a type by the content, and SHA-1 digests of block and payload. Of equal
payloads of ``least`` bytes or more, the record with the largest number keeps the payload and the
others become revisits, which keep the HTTP head alone.

Archives are written with Spark's text sink, whose line feed is the last byte of a record in both
formats, so any store and a lost executor are no concern; no archive holds more than about
``ARCHIVE_BYTES``, so one fits a task's memory. Only archives are read back.

A null html is an empty payload, a null url ``urn:none``, a null page_id stays null. Rows with the
same page_id and payload are all responses if that id is the group's largest. Other columns of
the pages are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.session import scratch_dir

ARCHIVE_BYTES, LEAST = 16 << 20, 1000
ARC_DATE = "20240101000000"
# The header lines of the two versions.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_RECORDS = pa.schema([("number", pa.int64()), ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
                      ("head", pa.binary()), ("payload", pa.binary()), ("sha1", pa.binary()), ("sha256", pa.binary())])
_RECORD_KINDS = "number long, uri string, ip string, date string, mime string, head binary, payload binary, sha1 binary, sha256 binary"


class _Shelf:
    """Names archives of a task so that none grows far beyond the limit."""

    def __init__(self, opening):
        from pyspark import TaskContext

        self.part, self.nth, self.bytes, self.opening = TaskContext.get().partitionId(), -1, ARCHIVE_BYTES, opening
        self.names: list[str] = []
        self.records: list[bytes] = []

    def add(self, record) -> None:
        """``record`` makes the bytes from the archive's number."""
        if self.bytes >= ARCHIVE_BYTES:
            self.nth, self.bytes = self.nth + 1, 0
            self._put(self.opening(self.nth))
        self._put(record(self.nth))

    def _put(self, data: bytes) -> None:
        self.names.append(f"{self.part:06d}-{self.nth:05d}")
        self.records.append(data)
        self.bytes += len(data)

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(self.names, pa.string()), pa.array(self.records, pa.binary())], names=["archive", "record"])
        self.names, self.records = [], []
        return out


def _write(records: DataFrame, path: str) -> None:
    rows = records.select(F.col("record").cast("string").alias("value"), "archive")
    rows.write.partitionBy("archive").option("compression", "gzip").text(path)


def _archives(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")


def _open(content: bytes):
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))


def write_arc(pages: DataFrame, path: str) -> None:
    """Legacy archives of web pages, versions by turns; the page's id stands in the URL's fragment."""

    def rows(batches):
        def version(nth: int) -> str:
            return "12"[nth % 2]

        def opening(nth: int) -> bytes:
            body = f"{version(nth)} 0 lakeloom\n{ARC_FIELDS[version(nth)]}\n".encode()
            return _arc_header(version(nth), f"filedesc://pages-{nth}.arc", "text/plain", body) + body

        shelf = _Shelf(opening)
        for batch in batches:
            for number, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode()
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
                safe = "".join(c if c.isprintable() and not c.isspace() and c != "#" else "%%%02X" % ord(c) for c in url or "urn:none")
                uri = f"{safe}#record={'' if number is None else number}"
                shelf.add(lambda nth, u=uri, b=body: _arc_header(version(nth), u, "text/html", b) + b)
            yield shelf.batch()

    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(rows, "archive string, record binary"), path)


def _arc_header(version: str, uri: str, mime: str, body: bytes) -> bytes:
    more = "" if version == "1" else f" 200 {hashlib.md5(body).hexdigest()} - 0 pages.arc"
    return f"{uri} 0.0.0.0 {ARC_DATE} {mime}{more} {len(body)}\n".encode()


def arc_records(source):
    """(URL, address, date, type, body) of one open archive, by header lines and declared lengths."""
    fields = len(ARC_FIELDS["1"].split())
    while line := source.readline():
        if line in (b"\n", b"\r\n"):
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", fields - 1)
        if len(parts) != fields or not parts[-1].isdigit():
            raise ValueError(f"not an ARC header: {line[:200]!r}")
        size = int(parts[-1])
        body = source.read(size)
        if len(body) != size:
            raise ValueError(f"archive ends inside a record of {size} bytes: {parts[0][:200]}")
        if parts[0].startswith("filedesc:"):
            named = body.split(b"\n")
            fields = len((named[1] if len(named) > 1 else ARC_FIELDS["1"].encode()).split())
        yield parts[0], parts[1], parts[2], parts[3], body


def _number(uri: str) -> int | None:
    digits = uri.rpartition("#record=")[2]
    return int(digits) if digits.lstrip("-").isdigit() else None


def read_arc(spark, path: str) -> DataFrame:
    """Records of legacy archives with the digests of their payloads."""

    def rows(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for content in batch.column("content"):
                with _open(content.as_py()) as source:
                    for uri, ip, date, mime, body in arc_records(source):
                        if uri.startswith("filedesc:"):
                            continue
                        head, gap, payload = body.partition(b"\r\n\r\n") if body.startswith(b"HTTP/") else (b"", b"", body)
                        held.append((_number(uri), uri, ip, date, mime, head + gap, payload, hashlib.sha1(payload).digest(), hashlib.sha256(payload).digest()))
                        size += len(body)
                        if size > 4 << 20:
                            yield _columns(held)
                            held, size = [], 0
        if held:
            yield _columns(held)

    return _archives(spark, path).mapInArrow(rows, _RECORD_KINDS)


def _columns(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RECORDS)], schema=_RECORDS)


def convert(spark, arc_path: str, warc_path: str, least: int = LEAST) -> None:
    """Write the WARC archives of all records of the legacy archives."""
    records = read_arc(spark, arc_path)
    groups = (
        records.where(F.octet_length("payload") >= least).groupBy("sha256")
        .agg(F.max("number").alias("kept"), F.count("*").alias("copies")).where("copies > 1").select("sha256", "kept")
    )
    decided = records.join(groups, "sha256", "left").withColumn("refers_to", F.when(F.col("number").eqNullSafe(F.col("kept")), None).otherwise(F.col("kept")))

    def rows(batches):
        shelf = _Shelf(lambda nth: warc_record("warcinfo", f"urn:archive:{nth}", ARC_DATE, "application/warc-fields", b"software: lakeloom\r\nformat: WARC File Format 1.1\r\n", b"", None))
        for batch in batches:
            for row in batch.to_pylist():
                if row["refers_to"] is not None:
                    other = row["uri"].rpartition("#record=")[0] + f"#record={row['refers_to']}"
                    made = warc_record("revisit", row["uri"], row["date"], None, row["head"], b"", row["sha1"], other)
                else:
                    kind = "response" if row["head"] else "resource"
                    made = warc_record(kind, row["uri"], row["date"], row["mime"], row["head"], row["payload"], row["sha1"])
                shelf.add(lambda nth, m=made: m)
            yield shelf.batch()

    _write(decided.select("number", "uri", "date", "mime", "head", "payload", "sha1", "refers_to").mapInArrow(rows, "archive string, record binary"), warc_path)


def warc_record(kind: str, uri: str, date: str, mime: str | None, head: bytes, payload: bytes, sha1: bytes | None, refers_to: str | None = None) -> bytes:
    """A record without its last line feed, which the sink adds."""
    block = head + payload
    iso = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14] or '00'}Z"
    digest = hashlib.sha1(block).digest()
    fields = [
        ("WARC-Type", kind), ("WARC-Target-URI", uri), ("WARC-Date", iso),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {kind} {digest.hex()}')}>"),
        ("Content-Type", "application/http; msgtype=response" if head and kind != "warcinfo" else mime or "application/octet-stream"),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(digest).decode()),
    ]
    if sha1:
        fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()))
    if refers_to:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Target-URI", refers_to), ("WARC-Refers-To-Date", iso)]
    fields.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r"


def warc_records(source):
    """(fields, block) of one open archive."""
    while line := source.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        fields = {}
        while (line := source.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = source.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError(f"archive ends inside {fields['warc-record-id']}")
        yield fields, block


def read_warc(spark, path: str) -> DataFrame:
    """What the archives say of each page; digests of responses are computed again and compared."""

    def rows(batches):
        for batch in batches:
            held = []
            for content in batch.column("content"):
                with _open(content.as_py()) as source:
                    for fields, block in warc_records(source):
                        kind = fields["warc-type"]
                        if kind == "warcinfo":
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n") if "msgtype" in fields["content-type"] else (b"", b"", block)
                        told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        size = len(payload)
                        if kind == "revisit":
                            size = next((int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
                        elif hashlib.sha1(payload).hexdigest() != told:
                            raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
                        refers = _number(fields["warc-refers-to-target-uri"]) if kind == "revisit" else None
                        held.append((_number(fields["warc-target-uri"]), size, told, kind, refers))
            if held:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return _archives(spark, path).mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to legacy archives, to WARC, and back to one row per page."""
    spark = pages.sparkSession
    legacy, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, legacy)
    convert(spark, legacy, warc)
    return read_warc(spark, warc)


#: The same rows from the table itself.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT html, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN m.kept IS NOT NULL AND m.kept <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.kept <> p.page_id THEN m.kept END AS refers_to
FROM p LEFT JOIN m ON p.html = m.html
"""
