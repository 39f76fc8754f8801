"""WARC archives: writing with segments and revisits, reading with segment reassembly.

Writing: a page becomes an HTTP response in chunked transfer framing. A block longer than
``SEGMENT`` bytes is written as several records: the first bears the page's own record id and
segment number 1, the continuation records name it as their origin, and the last states the
total length. So a record has a bounded size, and with ``RECORDS`` records a file so has a file.
Of pages with equal payloads (of ``least`` bytes or more) the one with the smallest id is a
response, the others are revisit records that refer to it. Archives are gzip files written
through Spark's committed text writer, on whatever store the path names.

Reading: files are parsed apart; continuation records are grouped by origin id, ordered by segment
number, verified against the total length, joined, and freed of their chunk framing. Records
that were never segmented take no part in that shuffle.

Defined cases: a null payload is the empty one; a null id sorts behind all others; repeated rows
with the smallest id are responses all; a null URL is written as ``urn:none``; an empty table
gives no record; other columns are not written. What is damaged is returned with its ``error``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import written

SEGMENT = 1 << 16
RECORDS = 256
CHUNK = 1 << 13
END = b"\r\n\r\n"
RECORD = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("origin", pa.string()), ("segment", pa.int32()),
    ("total", pa.int64()), ("target", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()),
    ("block", pa.binary()), ("error", pa.string()),
])
PAGE = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("error", pa.string()),
])
RECORD_DDL = "record_id string, record_type string, origin string, segment int, total long, target string, digest string, refers_to string, block binary, error string"
PAGE_DDL = "record_id string, record_type string, target string, payload binary, payload_bytes long, payload_digest string, refers_to string, error string"


def head(fields: list[tuple[str, object]], first: str) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields)]).encode() + END


def chunked(payload: bytes) -> bytes:
    parts = []
    for at in range(0, len(payload), CHUNK):
        piece = payload[at : at + CHUNK]
        parts += [f"{len(piece):x}\r\n".encode(), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def records(row: int, page_id: str, url: str | None, payload: bytes, sha1: str, refers_to: str | None) -> Iterator[bytes]:
    """The records of one page, each without the blank lines that end it. sha1: the payload's, in hexadecimal."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    record_id = f"<urn:page:{page_id}:{row}>"
    common = [("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", " ".join((url or "urn:none").split()))]
    typed = ("Content-Type", "text/html; charset=utf-8")
    if refers_to is not None:
        block = head([typed, ("Content-Length", len(payload))], "HTTP/1.1 200 OK")
        more = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    else:
        block = head([typed, ("Transfer-Encoding", "chunked")], "HTTP/1.1 200 OK") + chunked(payload)
        more = []
    parts = [block[at : at + SEGMENT] for at in range(0, len(block), SEGMENT)]
    for k, part in enumerate(parts, 1):
        if k == 1:
            fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), *more]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{page_id}:{row}:{k}>"), *common, ("WARC-Segment-Origin-ID", record_id)]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", k))
            if k == len(parts):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        yield head([*fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(part))], "WARC/1.1") + part


def to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, size = [], 0
        for page_id, url, payload, digest, refers_to, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for r in records(row, page_id, url, payload, digest, refers_to):
                out.append(r)
                size += len(r)
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> None:
    """Writes the archives below ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("row")
    ).withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload")
    firsts = rows.where(size >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # a table of its own: its join below then has two plain exchanges, of which Spark splits a hot digest
    firsts = written(firsts.where("n > 1").select("digest", "first"), "payloads")
    rows = rows.join(firsts, "digest", "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "payload", "digest",
        F.when((size >= least) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"),
        "row",
    )
    done = rows.mapInArrow(to_records, "value binary").select(F.col("value").cast("string").alias("value"))
    done.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS).text(path)


def parsed(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    at = 0
    while at < len(data):
        end = data.find(END, at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else [""]
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
            yield {"error": f"no record at byte {at}"}
            return
        at = end + 4 + int(fields["content-length"])
        block = data[end + 4 : at]
        whole = len(block) == int(fields["content-length"]) and data[at : at + 4] == END
        at += 4
        yield {
            "record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            "origin": fields.get("warc-segment-origin-id") or fields.get("warc-record-id"),
            "segment": int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None,
            "total": int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
            "target": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": fields.get("warc-refers-to"), "block": block, "error": None if whole else "a record is cut short",
        }


def parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            if data[:2] == b"\x1f\x8b":
                whole, rest = [], data
                while rest:  # an archive may be one gzip member or one a record
                    d = zlib.decompressobj(31)
                    whole.append(d.decompress(rest) + d.flush())
                    rest = d.unused_data
                data = b"".join(whole)
            out, size = [], 0
            for r in parsed(data):
                out.append(r)
                size += len(r.get("block") or b"")
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, RECORD)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, RECORD)


def unframed(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and the payload, freed of chunked framing."""
    top, _, body = block.partition(END)
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in top.decode("utf-8", "replace").split("\r\n")[1:])}
    if fields.get("transfer-encoding", "").lower() != "chunked":
        return fields, body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if not n:
            return fields, b"".join(out)
        piece = body[end + 2 : end + 2 + n]
        if len(piece) < n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(piece)
        at = end + 4 + n


def page(r: dict, block: bytes) -> dict:
    out = {k: r.get(k) for k in ("record_id", "record_type", "target", "refers_to", "error")} | {"payload": None, "payload_bytes": None, "payload_digest": r.get("digest")}
    if out["error"]:
        return out
    try:
        fields, payload = unframed(block)
        if r["record_type"] == "revisit":
            return out | {"payload_bytes": int(fields["content-length"])}
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        wrong = r.get("digest") not in (None, digest)
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "error": "the payload digest differs" if wrong else None}
    except (ValueError, KeyError) as e:
        return out | {"error": f"damaged block: {e}"}


def whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pylist([page(r, r["block"] or b"") for r in batch.to_pylist()], PAGE)


def reassembled(table: pa.Table) -> pa.Table:
    """All records of one origin id -> its page."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    r, block = rows[0], b"".join(x["block"] for x in rows)
    error = next((x["error"] for x in rows if x["error"]), None)
    if [x["segment"] for x in rows] != list(range(1, len(rows) + 1)) or rows[-1]["total"] is None:
        error = error or "a segment is missing or doubled"
    elif rows[-1]["total"] != len(block):
        error = error or "the segments don't have the stated total length"
    return pa.Table.from_pylist([page(r | {"error": error}, block)], PAGE)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records: record_id, record_type, target, payload (null for revisits), payload_bytes,
    payload_digest, refers_to, error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInArrow(parse_files, RECORD_DDL)
    whole = found.where(F.col("segment").isNull()).mapInArrow(whole_pages, PAGE_DDL)
    parts = found.where(F.col("segment").isNotNull()).groupBy("origin").applyInArrow(reassembled, PAGE_DDL)
    return whole.unionByName(parts)


def page_id(record_id: Column) -> Column:
    """The id in a record id, null if it was null."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:([^:>]*)", 1), F.lit(""))
