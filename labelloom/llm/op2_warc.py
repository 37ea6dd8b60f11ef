"""WARC archives: written as text files by Spark, read back by a reader that survives damage.

A record passes if its version line and header are whole, its block lies inside the archive and is followed by the end mark, and its
digest, where given, holds. Where a check fails, the reader looks for the next version line or member that passes; the bytes between are quarantined: a row with
their place and the reason, no record. Later records are kept. Compressed members are inflated in steps: what came out before a fault is
searched like an archive of its own, so the records of a cut or damaged member that are whole are kept too, and the member is quarantined beside them.
Rows of one member have its offset; its length stands in the quarantine row if it is damaged, else in its first row, and the others have 0, so lengths
add up to the archive. Faults inside an undamaged member have rows of length 0.

Every record carries its payload, so damage to one record costs no other. Which of equal payloads counts as response and which revisit
it is decided from the digests read back.

Null html: an empty payload. Null url or page_id: no such header, null again when read; a page id that is no 64-bit number is null. Line breaks in a url are written as
%0D and %0A. Rows with equal page_id and payload: all are response. Rows with null page_id revisit another page if there is one, else they are response.
An empty table gives no rows. The reader holds an archive (and an inflated member) in memory as a whole; ``TIERS`` bound the archives that are written, by bytes, and drop nothing.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.session import cut_lineage

VERSION, GZIP = b"WARC/1.", b"\x1f\x8b\x08"
#: A version line and lines of a name and a value, or folded.
HEAD = re.compile(rb"WARC/1\.[0-9]+(?:\r\n(?:[!-9;-~]+:|[ \t])[^\r\n]*)*+")
#: Payloads from this many bytes on can be revisits.
REVISIT_FROM = 100
#: (most bytes of a page, records of an archive): archives of small pages hold at most 64 MB beside their headers, and a larger page is alone.
TIERS = ((1 << 16, 1000), (1 << 22, 16), (1 << 62, 1))
#: Compressed bytes that are inflated at a time.
STEP = 1 << 14


def record(page_id: Column, url: Column, html: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """One record without its end mark, as text: UTF-8 payload, byte lengths."""
    payload = F.coalesce(html, F.lit(""))
    uid = F.md5(F.concat_ws("|", page_id.cast("string"), url))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"), F.concat_ws("-", *[F.substring(uid, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        F.lit(f">\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\r\n")), F.lit("")),
        F.coalesce(F.concat(F.lit("WARC-Page-ID: "), page_id.cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha256:"), F.sha2(payload, 256), F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, payload)


def write(pages: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """A folder of archives; Spark's commit keeps lost or repeated tasks from leaving halves or doubles. Pages of different sizes go to archives of their own."""
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    largest = pages.agg(F.max(size)).first()[0] or 0
    low = -1
    for most, records in TIERS:
        some = pages if largest <= TIERS[0][0] else pages.filter((size > low) & (size <= most))
        rows = some.select(record(F.col("page_id"), F.col("url"), F.col("html")).alias("value"))
        rows.write.mode("errorifexists" if low < 0 else "append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", min(records, records_per_file)).text(path)
        if largest <= most:
            break
        low = most


def header(raw: bytes) -> dict[str, str]:
    """Names in lower case; folded lines belong to the one before."""
    out, last = {}, ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def at_version(buf: bytes, pos: int) -> tuple[dict[str, str], bytes, int] | str:
    """(header, block, end) of the record at a version line, or what is wrong with it."""
    top = buf.find(b"\r\n\r\n", pos)
    if top < 0:
        return "header without end"
    if not HEAD.fullmatch(buf, pos, top):
        return "header"
    head = header(buf[pos:top])
    if not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        return "no length"
    begin = top + 4
    end = begin + int(head["content-length"])
    if end > len(buf):
        return "truncated"
    if buf[end:end + 4] != b"\r\n\r\n":
        return "no end mark"
    block = buf[begin:end]
    kind, _, want = head.get("warc-payload-digest", "").partition(":")
    if kind == "sha256" and head.get("warc-type") != "revisit" and hashlib.sha256(block).hexdigest() != want.lower():
        return "digest"
    return head, block, end + 4


def member_data(buf: bytes, pos: int) -> int:
    """Where the compressed data of the member at ``pos`` begins, behind the optional fields of its head."""
    flags, at = buf[pos + 3:pos + 4], pos + 10
    flags = flags[0] if flags else 0
    if flags & 4:
        at += 2 + int.from_bytes(buf[at:at + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            at = buf.find(b"\0", at) + 1 or len(buf)
    return at


def inflated(buf: bytes, pos: int) -> tuple[bytes, int, str]:
    """(what came out, end, fault or empty) of the compressed member at ``pos``."""
    if buf.find(GZIP, pos + 3, member_data(buf, pos)) >= 0:
        return b"", pos, "member"  # another member begins in what would be its head
    member, out, at = zlib.decompressobj(31), [], pos
    while at < len(buf) and not member.eof:
        before, piece = member.copy(), buf[at:at + STEP]
        try:
            out.append(member.decompress(piece))
        except zlib.error:
            for i in range(len(piece)):  # up to the byte at fault
                try:
                    out.append(before.decompress(piece[i:i + 1]))
                except zlib.error:
                    break
            return b"".join(out), at, "member"
        at += len(piece)
    return b"".join(out), at - len(member.unused_data), "" if member.eof else "truncated member"


def salvage(buf: bytes, members: bool = True) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(offset, length, header, payload, fault) of each record; of each quarantined gap with header None and the first fault in it."""
    pos, gap, fault = 0, None, ""
    while pos < len(buf):
        found, wrong, end = [], "no version line", pos
        if buf.startswith(VERSION, pos):
            got = at_version(buf, pos)
            wrong, found, end = (got, [], pos) if isinstance(got, str) else ("", [(*got[:2], "")], got[2])
        elif members and buf.startswith(GZIP, pos):
            raw, end, wrong = inflated(buf, pos)
            inner = [row[2:] for row in salvage(raw, False)]
            found = inner if not wrong else [row for row in inner if row[0] is not None]
            if not any(row[0] is not None for row in inner):
                found, wrong = [], wrong or (inner[0][2] if inner else "empty member")
        if found and gap is not None:
            yield gap, pos - gap, None, b"", fault
            gap = None
        for i, (head, block, inside) in enumerate(found):
            yield pos, 0 if i or wrong else end - pos, head, block, inside
        if not wrong:
            pos = end
            continue
        if gap is None:
            gap, fault = pos, wrong
        # what a damaged member has given is not looked for again in its bytes, only the next member or what follows the fault
        places = [buf.find(GZIP, pos + 1), buf.find(VERSION, max(pos + 1, end if found else 0))]
        pos = min((x for x in places if x >= 0), default=len(buf))
    if gap is not None:
        yield gap, len(buf) - gap, None, b"", fault


def page_number(text: str | None) -> int | None:
    """The page id of a header; null if it is no 64-bit number."""
    if not text or not re.fullmatch("[+-]?[0-9]{1,19}", text):
        return None
    n = int(text)
    return n if -1 << 63 <= n < 1 << 63 else None


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """archive, offset, length, fault (null for records), warc_type, record_id, url, page_id, payload_bytes, payload_digest and payload."""
    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, length, head, block, fault in salvage(content.as_py()):
                    if head is None:
                        rows.append((archive, offset, length, fault, *[None] * 7))
                    else:
                        rows.append((archive, offset, length, None, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"), page_number(head.get("warc-page-id")),
                                     len(block), hashlib.sha256(block).hexdigest(), block if payload else None))
                for i in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 500]), TYPES)], names=NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, "archive string, offset long, length long, fault string, warc_type string, record_id string, url string, page_id long, payload_bytes long, payload_digest string, payload binary")


NAMES = ["archive", "offset", "length", "fault", "warc_type", "record_id", "url", "page_id", "payload_bytes", "payload_digest", "payload"]
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to. Rows are small: payloads are not shuffled."""
    rows = cut_lineage(records.filter("fault is null").select("page_id", "payload_bytes", "payload_digest"))  # archives are read once
    first = rows.filter(F.col("payload_bytes") >= REVISIT_FROM).groupBy(F.col("payload_digest").alias("d")).agg(F.min("page_id").alias("first"))
    again = (F.col("payload_bytes") >= REVISIT_FROM) & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return rows.join(first, F.col("payload_digest") == F.col("d"), "left").select(
        "page_id", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))
