"""WARC archives: a writer of one gzip member per record, and a reader that salvages damaged archives."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm.common import PIECE_BYTES, map_batches, save

MIN_REVISIT_BYTES, BROADCAST_ROWS, ARCHIVE_RECORDS, ARCHIVE_BYTES, BATCH_RECORDS = 100, 100_000, 16_384, 1 << 30, 4_096
GZIP_MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
_ENTRY = "path string, kind string, start_byte long, end_byte long, reason string, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def record(kind: str, record_id: str, url: str | None, digest: str, payload: bytes, size: int, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, whose Content-Length is that of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()  # noqa: S324  the format's usual digest
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha1:{block_digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member (and an empty one after it where needed) whose last byte is zero."""
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    out = c.compress(data) + c.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, size and first_id: the smallest page_id of an equal payload, null if no page precedes.

    Only digests are grouped, with partial minima before the shuffle. Firsts of repeated payloads are sent
    out while they are few and joined by digest beyond that. Null html is empty; rows without page_id precede none.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    firsts = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = save(firsts, "first_payloads")
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    rows = rows.join(firsts, "digest", "left")
    return rows.withColumn("first_id", F.when(F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(None)).otherwise(F.col("first_id")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, archive_records: int = ARCHIVE_RECORDS, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """``pages`` (page_id, url, html, any other columns) as archives under ``path``, a gzip member per record; an empty table writes none.

    An archive takes at most ``archive_records`` records and ``archive_bytes`` of html and url (but one larger record):
    records are written by classes of size, sixteenfold each, so that a class's number of records bounds its bytes.
    Null html is empty, null url is left out, rows that repeat a page_id or have none are records of their own (of
    equal payloads with the smallest page_id, all rows of that page_id are responses), other columns are left out.

    Spark's text writer makes the files, so any of its stores will do and lost tasks leave nothing behind.
    It ends each value with a separator; a member's last byte, always zero, serves as that.
    """

    def write(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for x in batch.to_pylist():
            first = x["first_id"]
            data = record("response" if first is None else "revisit", _urn(x["page_id"]), x["url"], x["digest"], x["html"].encode(), x["size"], None if first is None else _urn(first))
            out.append(member(data)[:-1])
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    least = max(1, archive_bytes // archive_records)
    rows = with_revisits(pages, min_bytes)
    weight = F.octet_length(F.coalesce("html", F.lit(""))) + F.octet_length(F.coalesce("url", F.lit("")))
    level = F.lit(0)
    for i in range(8):
        level = level + (weight > least * 16**i).cast("int")
    for k, *_ in sorted(pages.select(level.alias("level")).distinct().collect()):  # 9 values at most
        members = map_batches(rows.where(level == k), write, "value binary").select(F.col("value").cast("string"))
        members.write.mode("append").option("lineSep", "\0").option("maxRecordsPerFile", max(1, archive_records // 16**k)).text(path)


def parse_record(data: memoryview | bytes, at: int) -> tuple[dict, int] | str:
    """The record at ``at`` with the offset after it, or why it fails."""
    size = 65536
    while (end := bytes(data[at : at + size]).find(b"\r\n\r\n")) < 0:
        if at + size >= len(data):
            return "header without end"
        size *= 4
    lines = bytes(data[at : at + end]).split(b"\r\n")
    if not lines[0].startswith(VERSION):
        return "no version line"
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "malformed header"
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", head.get("content-length", "")):
        return "no content length"
    begin, size = at + end + 4, int(head["content-length"])
    if begin + size + 4 > len(data):
        return "truncated"
    if bytes(data[begin + size : begin + size + 4]) != b"\r\n\r\n":
        return "no record end"
    block = bytes(data[begin : begin + size])
    digest = head.get("warc-block-digest", "")
    if digest.startswith("sha1:") and base64.b32encode(hashlib.sha1(block).digest()).decode() != digest[5:]:  # noqa: S324
        return "block digest differs"
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and digest.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest[7:]:
        return "payload digest differs"
    full = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})", http)
    return {
        "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id", "").strip("<>"), "target_uri": head.get("warc-target-uri"), "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        "payload_bytes": int(full[1]) if head.get("warc-type") == "revisit" and full else len(payload), "payload_digest": digest.rpartition(":")[2] or None, "payload": payload,
    }, begin + size + 4


def _inflate(data: memoryview, at: int, until: int | None = None) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds as far as it can be read (or its first ``until`` bytes at least), the offset after what was read, and why it stopped."""
    z, out, size, i = zlib.decompressobj(31), [], 0, at
    step = 65536
    while not z.eof and i < len(data) and (until is None or size < until):
        before = z.copy()
        try:
            part = z.decompress(data[i : i + step])
        except zlib.error as e:
            if step == 1:
                return b"".join(out), i, f"gzip: {str(e)[:60]}"
            z, step = before, 1  # byte by byte up to the damage
            continue
        if step > 1 and until is not None and size + len(part) >= until:
            z, step = before, 1
            continue
        out.append(part)
        size += len(part)
        i += step
    end = min(i, len(data)) - len(z.unused_data)
    return b"".join(out), end, None if z.eof or until is not None else "gzip: truncated"


def parse_member(data: memoryview, at: int) -> tuple[list[dict], list[str], int, str | None] | str:
    """The valid records of the gzip member at ``at``, the gaps between them, the offset after it and why it breaks off there; or why it has none.

    Within the content, too, the search goes on for the next version line after a failed check. Of a damaged
    member the offset is that after the last valid record.
    """
    content, end, damage = _inflate(data, at)
    out, gaps, k, good, why = [], [], 0, 0, None
    while k < len(content):
        found = parse_record(content, k)
        if isinstance(found, str):
            why = why or found
            k = content.find(VERSION, k + 1)
            k = len(content) if k < 0 else k
            continue
        if why:
            gaps.append(f"{why} (bytes {good} to {k} of the member's content)")
            why = None
        out.append(found[0])
        k = good = found[1]
    if not out and (damage or why):
        return damage or why
    if damage:
        return out, gaps, _inflate(data, at, good)[1], damage
    return out, gaps + ([f"{why} (bytes {good} to {len(content)} of the member's content)"] if why else []), end, None


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, list[dict]]]:
    """(start, end, reason, records) in order of place: whole records without a reason, quarantined gaps with the first one.

    Where a check fails, the search goes on byte by byte for the next gzip member or version line that
    passes all checks; whatever lies before it is the gap. Gaps within a member that has valid records have the
    member's place.
    """
    view, at, gap, why = memoryview(data), 0, None, None
    while at < len(data):
        found: tuple | str
        if data.startswith(GZIP_MAGIC, at):
            found = parse_member(view, at)
        elif data.startswith(VERSION, at):
            found = parse_record(view, at)
        else:
            found = "no member or version line"
        if isinstance(found, str):
            if gap is None:
                gap, why = at, found
            m = _NEXT.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if gap is not None:
            yield gap, at, why, []
            gap = None
        if isinstance(found[0], dict):
            found = [found[0]], [], found[1], None
        records, inner, end, damage = found
        yield at, end, None, records
        for reason in inner:
            yield at, end, reason, []
        if damage:
            gap, why = end, damage
        at = end
    if gap is not None:
        yield gap, len(data), why, []


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records (kind ``record``) and quarantined gaps (kind ``gap``, with byte range and reason) of the archives under ``path``.

    Reads gzip members and plain records, mixed as they come. An archive is one task's work: keep archives
    to some hundred MB, as the writer does. Records leave the task in small batches, so it holds an
    archive's bytes but never all its payloads. An empty archive gives nothing.
    """
    names = [x.split()[0] for x in _ENTRY.split(", ")]
    types = [pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string() for t in (x.split()[1] for x in _ENTRY.split(", "))]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for start, end, reason, found in salvage(data.as_py()):
                    place = {"path": name, "start_byte": start, "end_byte": end, "reason": reason}
                    rows += [place | {"kind": "gap"}] if reason else [place | {"kind": "record"} | x for x in found]
                    held += sum(len(x["payload"]) for x in found)
                    if held >= PIECE_BYTES or len(rows) >= BATCH_RECORDS:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, _ENTRY)
