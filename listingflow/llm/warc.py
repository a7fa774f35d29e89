"""WARC archives: write pages as records, read them back, reassemble segmented records.

Writing: one record per page.  Of equal payloads the one with the smallest page id is a
``response`` (its HTTP body in chunked framing), the others are ``revisit`` records that name it.
A response longer than a segment becomes a first segment and ``continuation`` records with the
origin's record id, their segment number and, in the last, the total length.

Reading: records without segments are decoded where they are parsed.  Segments are grouped by
origin id, put in order of segment number, checked for gaps and against the total length,
joined, and their chunked framing decoded.  Revisits take length and digest from the response
they refer to.  ``problem`` names what is wrong with a record (null: nothing); a damaged record
never ends the job.

Files: Spark's text writer (gzip), one file per task, with the record separator as line
separator, so the files are plain sequences of WARC records and are committed with the job.
Payloads move in one shuffle, by a hash of the row; groups of equal payloads meet only as
(digest, page id) rows, where the smallest id is found with map-side aggregation.

Edge cases: a null html is an empty payload; null page ids count as larger than all others; of
rows that are equal in every column one is the response and the rest revisit it; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage_path, table

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
LEAST_REVISIT_BYTES = 0
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame(payload: bytes) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), CHUNK_BYTES):
        part = payload[i:i + CHUNK_BYTES]
        parts.append(b"%x\r\n%b\r\n" % (len(part), part))
    return b"".join(parts) + b"0\r\n\r\n"


def unframe(body: bytes) -> bytes:
    """Decode chunked transfer framing; ValueError if it is damaged."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut")
        parts.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Decoded payload of an HTTP response block."""
    cut = block.index(_END)
    head, body = block[:cut].lower(), block[cut + 4:]
    return unframe(body) if b"\r\ntransfer-encoding: chunked" in head else body


def urn(key: str) -> str:
    return f"<urn:uuid:{key[:8]}-{key[8:12]}-{key[12:16]}-{key[16:20]}-{key[20:32]}>"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return b"WARC/1.1\r\n%b%b\r\n%b" % (lines.encode(), b"Content-Length: %d\r\n" % len(block), block)


def records_of(row: dict, segment_bytes: int):
    """The records of one written row: its response with continuations, and its revisits."""
    about = [("WARC-Date", _DATE), ("WARC-Target-URI", row["url"] and quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~")),
             ("WARC-Page-ID", row["page_id"]), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
             ("Content-Type", "application/http;msgtype=response")]
    copies = range(row["copies"])
    if row["key"] == row["first_key"] or not row["shared"]:
        block = _HTTP + frame((row["html"] or "").encode())
        for n in copies if not row["shared"] else copies[:1]:
            own = urn(row["key"] if n == 0 else hashlib.sha1(f"{row['key']}/{n}".encode()).hexdigest())
            if len(block) <= segment_bytes:
                yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *about], block)
                continue
            yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *about, ("WARC-Segment-Number", 1)], block[:segment_bytes])
            for k, i in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
                last = i + segment_bytes >= len(block)
                yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", urn(hashlib.sha1(f"{own}/{k}".encode()).hexdigest())),
                              ("WARC-Date", _DATE), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
                              ("WARC-Segment-Total-Length", len(block) if last else None)], block[i:i + segment_bytes])
        copies = [] if not row["shared"] else copies[1:]
    for n in copies:
        own = urn(row["key"] if n == 0 else hashlib.sha1(f"{row['key']}/{n}".encode()).hexdigest())
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, ("WARC-Refers-To", urn(row["first_key"])),
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b"")


def write_records(segment_bytes: int):
    """Task function: rows -> records, after a warcinfo record."""
    def run(batches):
        begun = False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun:
                    info = b"software: listingflow\r\nformat: WARC File Format 1.1\r\n"
                    out.append(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", urn(hashlib.sha1(row["key"].encode()).hexdigest())),
                                       ("WARC-Date", _DATE), ("Content-Type", "application/warc-fields")], info))
                    begun = True
                row["digest"] = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                out.extend(records_of(row, segment_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
    return run


def write_warc(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files in a new folder."""
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
            .withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
            .withColumn("key", F.sha1(F.to_json(F.struct("page_id", "url", "digest"), {"ignoreNullFields": "false"}))))
    whole = rows.groupBy("key").agg(*(F.first(c).alias(c) for c in ("page_id", "url", "digest", "html")), F.count("*").alias("copies"))
    named = rows.select("key", "page_id", "url", "digest", (F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes).alias("shared"))
    least = named.groupBy(F.col("digest").alias("of")).agg(F.min(F.struct(
        F.col("page_id").isNull().alias("a"), "page_id", F.col("url").isNull().alias("b"), "url", "key")).alias("least"))
    marks = (named.select("key", "digest", "shared").distinct().join(least, F.col("digest") == F.col("of"))
             .select("key", "shared", F.col("least.key").alias("first_key")))
    (whole.join(marks, "key").mapInArrow(write_records(segment_bytes), "record binary")
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder))


def parse(content: bytes):
    """Yield ``(headers, block)`` for the records of a file's content."""
    if content[:2] == b"\x1f\x8b":
        whole, rest = [], content
        while rest:  # gzip members one after another
            d = zlib.decompressobj(31)
            whole.append(d.decompress(rest))
            rest = d.unused_data
        content = b"".join(whole)
    at = 0
    while at < len(content):
        cut = content.index(_END, at)
        headers = {}
        for line in content[at:cut].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode()
        at = cut + 4
        end = at + int(headers["content-length"])
        yield headers, content[at:end]
        at = end + 4


def checked(block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None]:
    """Length and digest of a response's payload, and what is wrong with it."""
    try:
        payload = payload_of(block)
    except ValueError as e:
        return None, None, f"framing: {e}"
    found = digest32(payload)
    return len(payload), found, None if digest in (None, found) else "payload digest differs"


_PARSED = ("type string, record_id string, page_id long, origin string, segment long, total long, digest string, refers string, "
           "payload_bytes long, payload_digest string, problem string, block binary")


def parse_files(batches):
    """Task function: files -> records; whole responses decoded, segments with their block."""
    names = [f.split()[0] for f in _PARSED.split(", ")]
    for batch in batches:
        for content in batch.column("content").to_pylist():
            out = []
            for h, block in parse(content):
                kind, number = h["warc-type"], h.get("warc-segment-number")
                if kind not in ("response", "continuation", "revisit"):
                    continue
                digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                whole = (None, None, None)
                if kind == "response" and number is None:
                    whole = checked(block, digest)
                own = h["warc-record-id"]
                page, total = h.get("warc-page-id"), h.get("warc-segment-total-length")
                out.append((kind, own, page and int(page), h.get("warc-segment-origin-id", own), number and int(number), total and int(total),
                            digest, h.get("warc-refers-to"), *whole, block if number else None))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=_schema())


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in _PARSED.split(", "))])


def reassemble(batches):
    """Task function: the segments of one origin per row -> the whole response."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            numbers = [s["segment"] for s in row["segments"]]
            block = b"".join(s["block"] for s in row["segments"])
            size, digest, problem = None, None, None
            if numbers != list(range(1, len(numbers) + 1)):
                problem = "segments missing or repeated"
            elif row["total"] != len(block):
                problem = "total length differs"
            else:
                size, digest, problem = checked(block, row["digest"])
            out.append({"record_id": row["origin"], "page_id": row["page_id"], "payload_bytes": size, "payload_digest": digest, "problem": problem})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                                                                ("payload_digest", pa.string()), ("problem", pa.string())]))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response or revisit record of the WARC files in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    records = files.mapInArrow(parse_files, _PARSED)
    columns = ["record_id", "page_id", "payload_bytes", "payload_digest", "problem"]
    segments = records.filter("segment is not null")
    joined = (segments.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("segments"),
                                             *(F.max(c).alias(c) for c in ("total", "digest", "page_id")))
              .mapInArrow(reassemble, "record_id string, page_id long, payload_bytes long, payload_digest string, problem string"))
    responses = records.filter("type = 'response' and segment is null").select(*columns).unionByName(joined)
    revisits = records.filter("type = 'revisit'").select(F.col("page_id").alias("own"), "digest", "refers")
    resolved = (revisits.join(responses.withColumn("found", F.lit(True)), F.col("refers") == F.col("record_id"), "left")
                .select(F.col("own").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
                        F.col("page_id").alias("refers_to"),
                        F.when(F.col("found").isNull(), "response missing").when(F.col("digest") != F.col("payload_digest"), "payload digest differs")
                        .otherwise(F.col("problem")).alias("problem")))
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to"), "problem").unionByName(resolved)


def query(spark, sf_dir):
    folder = stage_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return read_warc(spark, folder).drop("problem")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex),
b AS (SELECT hex, CAST(unhex(hex) AS BIT)::VARCHAR AS bits FROM f),
d AS (SELECT hex, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
          + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS digest FROM b)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f USING (hex) JOIN d USING (hex)
"""
