"""WARC archives: writing pages as records, reading them back, and reassembling segments.

A page becomes an HTTP response with chunked transfer coding inside a WARC record. Blocks longer than
``SEGMENT`` characters are cut: the first segment is the response record, the rest are continuation
records with the same origin id and a segment number, the last of which states the total length.
Pages with equal payloads are written as revisit records that refer to the one with the smallest
page_id and carry no payload.

Records are written by Spark's text writer, whose line separator is the blank line that ends a
record, so the files are plain WARC in the folder that all executors share and lost tasks are
redone by Spark's committer. A file holds ``FILE_RECORDS`` records of a bounded size, so it fits a
task. Reading takes each file whole, walks its records by their stated lengths, and groups
continuation records by origin id; only those are shuffled.

Defined cases: null html is an empty payload; a null url is an empty target; rows without page_id
have one of the records ``urn:page:null``, told apart by their digest, and revisit a page with an equal
payload and an id; equal payloads whose ids are all null are responses; rows that repeat page_id and html are written once per row and
are all of one type; an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.llm.staging import new_path, staged

#: Payloads of fewer bytes are responses even when repeated.
LEAST_REVISIT = 0
SEGMENT = 32 << 10
CHUNK = 8 << 10
FILE_RECORDS = 2048
_STAMP = "2024-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _chunked(payload: bytes) -> str:
    """Chunked transfer framing; a chunk ends at a character, so the whole stays text."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + CHUNK, len(payload))
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end += 1
        out.append(f"{end - at:x}\r\n{payload[at:end].decode()}\r\n")
        at = end
    return "".join(out) + "0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body: sizes in hex with optional extensions, then a zero chunk."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        if body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        at = line + 4 + size


def _record(headers: dict[str, object], block: str) -> str:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block.encode())}\r\n\r\n{block}"


def _one_line(text: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", text or "")


def _records(page: dict) -> Iterator[str]:
    payload = (page["html"] or "").encode()
    digest = _digest(payload)
    identifier = f"<urn:page:{page['page_id'] if page['page_id'] is not None else f'null:{digest}'}>"
    common = {"WARC-Target-URI": _one_line(page["url"]), "WARC-Date": _STAMP, "Content-Type": "application/http;msgtype=response"}
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    about = {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Payload-Length": len(payload)}
    if page["refers_to"] is not None:
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": identifier, **common, **about, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{page['refers_to']}>"}, http)
        return
    block = http + _chunked(payload)
    pieces = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    for number, piece in enumerate(pieces, 1):
        cut = {"WARC-Segment-Number": number} if len(pieces) > 1 else {}
        if number > 1:
            cut |= {"WARC-Segment-Origin-ID": identifier}
            if number == len(pieces):
                cut |= {"WARC-Segment-Total-Length": len(block.encode())}
            yield _record({"WARC-Type": "continuation", "WARC-Record-ID": f"{identifier[:-1]}:{number}>", **common, **cut}, piece)
        else:
            yield _record({"WARC-Type": "response", "WARC-Record-ID": identifier, **common, **about, **cut}, piece)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, size = [], 0
        for i in range(batch.num_rows):
            page = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            for record in _records(page):
                rows.append(record)
                size += len(record)
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(rows, pa.string())], ["value"])
                    rows, size = [], 0
        if rows:
            yield pa.record_batch([pa.array(rows, pa.string())], ["value"])


def with_references(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html of ``pages`` and refers_to, the smallest page_id with an equal payload of
    at least ``least`` bytes where that is not the page itself."""
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    digests = staged(pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("bytes")), "digests")
    first = digests.filter(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.min("page_id").alias("refers_to"))
    later = digests.distinct().join(first, ["digest", "bytes"]).filter("refers_to IS NOT NULL AND (page_id IS NULL OR page_id <> refers_to)")
    # A page_id may go with several payloads; each row takes the entry of its own. Rows without one go by payload.
    key = later.withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.col("digest")))
    earlier = key.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("digest", "refers_to"))).alias("earlier"))
    refers = F.when(F.col("earlier").isNotNull(), F.try_element_at("earlier", F.sha1(html)))
    keyed = pages.withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.sha1(html)))
    return keyed.join(earlier, "key", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Write ``pages`` (page_id, url, html) to WARC files below ``path``."""
    records = with_references(pages, least).mapInArrow(_write, "value string")
    records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(path)


def _walk(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record starts where the last one ended")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        size = int(headers["Content-Length"])
        yield headers, content[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _record_row(headers: dict[str, str], block: bytes) -> tuple:
    segment, total = headers.get("WARC-Segment-Number"), headers.get("WARC-Segment-Total-Length")
    origin = headers.get("WARC-Segment-Origin-ID", headers["WARC-Record-ID"]) if segment else None
    return (
        headers["WARC-Record-ID"], headers["WARC-Target-URI"], headers["WARC-Type"], headers.get("WARC-Payload-Digest"), headers.get("WARC-Payload-Length"),
        headers.get("WARC-Refers-To"), origin, int(segment) if segment else None, int(total) if total else None, block,
    )


def _page_row(record: tuple) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a whole record, whose
    payload must have the digest and the length that it states."""
    identifier, _, kind, digest, length, refers, _, _, _, block = record
    stated, size = digest.removeprefix("sha1:"), int(length)
    if kind == "response":
        payload = unchunked(block[block.index(b"\r\n\r\n") + 4 :])
        if _digest(payload) != stated or len(payload) != size:
            raise ValueError(f"payload of {identifier} differs from its digest")
    page, other = (re.fullmatch(r"<urn:page:(-?\d+)>", x or "") for x in (identifier, refers))
    return int(page[1]) if page else None, size, stated, kind, int(other[1]) if other else None


def _archive_rows(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Records of archives; with ``whole``, those in one piece become page rows at once."""
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for headers, block in _walk(zlib.decompress(content.as_buffer(), 31)):
                record = _record_row(headers, block)
                if whole:
                    record = (*_page_row(record), *[None] * 10) if record[6] is None else (*[None] * 5, *record)
                rows.append(record)
                size += len(block)
                if size > 4 << 20:
                    yield _rows(rows, _PAGE_FIELDS + _FIELDS if whole else _FIELDS)
                    rows, size = [], 0
            if rows:
                yield _rows(rows, _PAGE_FIELDS + _FIELDS if whole else _FIELDS)


_PAGE_FIELDS = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_FIELDS = [
    ("id", pa.string()), ("url", pa.string()), ("type", pa.string()), ("digest", pa.string()), ("length", pa.string()),
    ("refers", pa.string()), ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("block", pa.binary()),
]
RECORDS = "id string, url string, type string, digest string, length string, refers string, origin string, segment long, total long, block binary"


def _rows(rows: list[tuple], fields: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows) if rows else [[]] * len(fields), fields)], [n for n, _ in fields])


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, as ``RECORDS``; segments apart."""

    def task(batches):
        yield from _archive_rows(batches, False)

    return _archives(spark, path).mapInArrow(task, RECORDS)


def _joined(table: pa.Table) -> list[tuple]:
    """The response record of one origin, whole again; once for each row that repeats the page."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    numbers: dict[int, list[dict]] = {}
    for r in rows:
        numbers.setdefault(r["segment"], []).append(r)
    copies = len(numbers.get(1, []))
    if sorted(numbers) != list(range(1, len(numbers) + 1)) or any(len(x) != copies for x in numbers.values()):
        raise ValueError(f"segments missing for {rows[0]['origin']}")
    out = []
    for copy in range(copies):
        own = [numbers[n][copy] for n in range(1, len(numbers) + 1)]
        block = b"".join(r["block"] for r in own)
        if len(block) != own[-1]["total"]:
            raise ValueError(f"{own[0]['id']} has {len(block)} bytes, not {own[-1]['total']}")
        whole = own[0] | {"block": block, "segment": None, "total": None, "origin": None}
        out.append(tuple(whole[n] for n, _ in _FIELDS))
    return out


def _joined_records(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_rows(_joined(table), _FIELDS)])


def _joined_pages(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_rows([_page_row(r) for r in _joined(table)], _PAGE_FIELDS)])


def reassembled(records: DataFrame) -> DataFrame:
    """``records`` with the segments of each origin joined; whole records stay where they are."""
    pieces = records.filter("origin IS NOT NULL").groupBy("origin").applyInArrow(_joined_records, RECORDS)
    return records.filter("origin IS NULL").union(pieces)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page's record.

    One pass over the archives; what is kept of it are page rows, and the blocks of segments.
    """

    def task(batches):
        yield from _archive_rows(batches, True)

    rows = staged(_archives(spark, path).mapInArrow(task, f"{PAGES}, {RECORDS}"), "records")
    names = [n for n, _ in _PAGE_FIELDS]
    pieces = rows.filter("origin IS NOT NULL").select(*[n for n, _ in _FIELDS])
    return rows.filter("origin IS NULL").select(*names).union(pieces.groupBy("origin").applyInArrow(_joined_pages, PAGES))


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return page_records(pages.sparkSession, path)
