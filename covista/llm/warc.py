"""Web archives: records in segments, written by Spark tasks and put together again.

Writing: a record is an HTTP response in chunked transfer framing. A block longer than a segment goes out as
a first record and continuation records that name it as their origin, number themselves and, in the last
one, give the total length. Records whose payload equals that of an earlier one become revisits. Each record is a gzip
member of its own, so that readers can seek it; archives are blobs of whole members of bounded size, a file each, in a
folder that Spark's file systems reach. A record's identifier has the row's own number, so equal rows stay apart.

Reading: archives are cut into records by their own lengths, never by searching for a marker. Records with
a segment number are grouped by their origin's identifier, ordered by number and checked for gaps, repeats
and the total length; the others need no grouping. Then the chunked framing is decoded and the digest
checked. A record that fails a check is returned with the reason, not dropped. A repeated identical
segment counts once. Rows, repeated ones included, come back one by one; null html is an empty payload; a table without
rows gives none. Columns but page, url and html are not read. A page is held whole by the tasks that write and join it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.plans import Workspace, scratch_path

SEGMENT_BYTES = 8 * 1024
ARCHIVE_BYTES = 16 * 1024 * 1024
CHUNK_BYTES = 8 * 1024
PIECE_BYTES = 4 * 1024
# of compression
LEVEL = 3
# payloads below this many bytes are always written
LEAST_SHARED = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, kind string, uri string, refers_to string, origin string, number int, total bigint, "
          "digest string, block binary")


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for at in range(0, len(payload), CHUNK_BYTES):
        part = payload[at:at + CHUNK_BYTES]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Payload of a body in chunked framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk of a wrong length")
        parts.append(body[at:at + size])
        at += size + 2


def clean(value: str | None) -> str:
    """A header's value without line breaks."""
    return " ".join((value or "").split())


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(made: bytes) -> bytes:
    """A record as a gzip member."""
    tool = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return tool.compress(made) + tool.flush()


def members(blob: bytes) -> Iterator[bytes]:
    """The records of an archive, member by member; input goes in by pieces, since what is left over is copied."""
    view, at = memoryview(blob), 0
    while at < len(blob):
        tool, parts = zlib.decompressobj(31), []
        while not tool.eof:
            piece = view[at:at + PIECE_BYTES]
            if not len(piece):
                raise ValueError("an archive ends within a member")
            parts.append(tool.decompress(piece))
            at += len(piece) - len(tool.unused_data)
        yield b"".join(parts)


def records(record_id: str, uri: str | None, refers_to: str | None, digest: str, payload: bytes, segment: int,
            date: str = "1970-01-01T00:00:00Z") -> Iterator[bytes]:
    """The record of a page, or its segments."""
    shared = [("WARC-Target-URI", clean(uri)), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *shared, http, ("WARC-Profile", PROFILE),
                      ("WARC-Refers-To", refers_to)], head)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = [block[at:at + segment] for at in range(0, len(block), segment)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *shared, http]
    if len(cuts) == 1:
        yield record(first, block)
        return
    yield record([*first, ("WARC-Segment-Number", 1)], cuts[0])
    for n, part in enumerate(cuts[1:], 2):
        total = [("WARC-Segment-Total-Length", len(block))] if n == len(cuts) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{record_id[:-1]}-{n}>"), *shared[:2],
                      ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", n), *total], part)


def parsed(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower case) and block of each record of an archive."""
    at = 0
    while at < len(blob):
        end = blob.index(b"\r\n\r\n", at)
        lines = blob[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, blob[start:stop]
        at = stop + 4


def marked(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(page, uri, payload, digest, refers_to): of rows with equal payloads of ``LEAST_SHARED`` bytes or
    more the smallest page is written whole, with others referring to it. Equal smallest pages are all
    written. Null pages
    never serve others."""
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.col(url).alias("uri"), F.encode(F.coalesce(html, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy(F.col("digest").alias("_digest"))
              .agg(F.count("*").alias("n"), F.min("page").alias("first")).where("n > 1").drop("n"))
    rows = rows.join(shared, rows["digest"] == shared["_digest"], "left")
    other = F.col("first").isNotNull() & (F.col("page").isNull() | (F.col("page") > F.col("first")))
    return rows.select("page", "uri", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def archives(rows: DataFrame, segment: int = SEGMENT_BYTES, size: int = ARCHIVE_BYTES, date: datetime | None = None) -> DataFrame:
    """(archive): blobs of whole gzip members; a blob is closed before it would exceed ``size``, and no record
    exceeds a segment and its headers. ``date`` is written as that of all records, by default the present."""
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def closed(held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    def run(batches):
        held, length = [], 0
        for batch in batches:
            for row, page, uri, payload, digest, refers in zip(*[batch.column(c) for c in ("row", "page", "uri", "payload", "digest", "refers_to")]):
                name = f"<urn:x-page:{'' if not page.is_valid else page.as_py()}:{digest.as_py()[:16]}:{row.as_py()}>"
                target = f"<urn:x-page:{refers.as_py()}>" if refers.is_valid else None
                for made in records(name, uri.as_py(), target, digest.as_py(), payload.as_py(), segment, stamp):
                    made = member(made)
                    if held and length + len(made) > size:
                        yield closed(held)
                        held, length = [], 0
                    held.append(made)
                    length += len(made)
        if held:
            yield closed(held)

    # the number of a row is made of its task's and its place there, so it is unique among what tasks hand in
    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "archive binary")


def write(blobs: DataFrame, path: str) -> None:
    """A file for each archive. The text writer writes the bytes as they are and ends a row by a byte of our choice:
    the zero that a gzip member of less than 16 MB ends with."""
    body = F.expr("substring(archive, 1, octet_length(archive) - 1)")
    (blobs.select(body.cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("compression", "none").option("lineSep", "\0").text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder of archives, of gzip members or plain."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                found, held = [], 0
                blob = content.as_py()
                for h, block in (x for part in (members(blob) if blob[:2] == b"\x1f\x8b" else [blob]) for x in parsed(part)):
                    number = h.get("warc-segment-number")
                    total = h.get("warc-segment-total-length")
                    found.append({"record_id": h.get("warc-record-id"), "kind": h.get("warc-type"), "uri": h.get("warc-target-uri"),
                                  "refers_to": h.get("warc-refers-to"), "origin": h.get("warc-segment-origin-id"),
                                  "number": int(number) if number else None, "total": int(total) if total else None,
                                  "digest": h.get("warc-payload-digest"), "block": block})
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(found, ARROW)
                        found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


ARROW = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("origin", pa.string()),
                   ("number", pa.int32()), ("total", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])


def reassembled(found: DataFrame) -> DataFrame:
    """(record_id, kind, uri, refers_to, digest, block, fault): one row per logical record.

    Segments of an origin are those of one page, so a group is as large as a page.
    """
    plain = found.where("number is null").select("record_id", "kind", "uri", "refers_to", "digest", "block", F.lit(None).cast("string").alias("fault"))
    first = F.col("number") == 1
    parts = (found.where("number is not null").withColumn("origin", F.coalesce("origin", "record_id")).groupBy("origin").agg(
        F.sort_array(F.collect_set(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"),
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "uri", "refers_to", "digest")]))
    numbers, block = F.transform("parts", lambda p: p["number"]), F.expr("reduce(parts, X'', (a, p) -> concat(a, p.block))")
    joined = parts.select(F.col("origin").alias("record_id"), "kind", "uri", "refers_to", "digest", block.alias("block"), "total", numbers.alias("numbers"))
    fault = (F.when(F.col("kind").isNull(), "no first segment")
             .when(F.col("numbers") != F.sequence(F.lit(1), F.greatest(F.size("numbers"), F.lit(1))), "segments missing or in conflict")
             .when(F.col("total").isNull(), "no last segment").when(F.octet_length("block") != F.col("total"), "wrong total length"))
    return plain.unionByName(joined.withColumn("fault", fault).drop("total", "numbers"))


def decoded(logical: DataFrame) -> DataFrame:
    """Adds payload: the body of the HTTP message without its framing. A body that can't be decoded, or
    whose digest differs, gives a fault; a revisit has no payload of its own."""

    @F.arrow_udf("struct<payload:binary,fault:string>")
    def body(blocks: pa.Array, kinds: pa.Array, digests: pa.Array) -> pa.Array:
        out = []
        for block, kind, digest in zip(blocks, kinds, digests):
            if kind.as_py() != "response" or not block.is_valid:
                out.append({"payload": None, "fault": None})
                continue
            head, _, rest = block.as_py().partition(b"\r\n\r\n")
            try:
                if any(x.replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.lower().split(b"\r\n")):
                    rest = unchunked(rest)
                same = not digest.is_valid or digest.as_py() == f"sha256:{hashlib.sha256(rest).hexdigest()}"
                out.append({"payload": rest, "fault": None if same else "wrong digest"})
            except ValueError as e:
                out.append({"payload": None, "fault": f"framing: {e}"})
        return pa.array(out, pa.struct([("payload", pa.binary()), ("fault", pa.string())]))

    return (logical.withColumn("_body", body("block", "kind", "digest"))
            .withColumn("payload", F.col("_body.payload")).withColumn("fault", F.coalesce("fault", "_body.fault")).drop("_body", "block"))


def stored_and_read(pages: DataFrame, segment: int = SEGMENT_BYTES, size: int = ARCHIVE_BYTES, **names) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, fault) of pages that were written to archives and
    read back. Null html is an empty payload. Payload figures of a revisit come from the record it refers to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(archives(marked(pages, **names), segment, size), path)
    back = decoded(reassembled(read(spark, path)))
    page = F.split(F.regexp_extract("record_id", "^<urn:x-page:(.*)>$", 1), ":")[0]
    target = F.regexp_extract("refers_to", "^<urn:x-page:(-?[0-9]+)>$", 1)
    rows = Workspace(spark).store(back.select(
        F.when(page != "", page).cast("bigint").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        F.col("kind").alias("record_type"), F.when(F.col("refers_to").isNotNull(), target).cast("bigint").alias("refers_to"),
        F.regexp_replace("digest", "^sha256:", "").alias("_digest"), "fault"), "records")
    whole = rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_of")).agg(
        F.max("payload_bytes").alias("_bytes"))
    revisits = rows.where("record_type = 'revisit'").join(
        whole, (F.col("refers_to") == F.col("_page")) & (F.col("_digest") == F.col("_of")), "left")
    resolved = revisits.select("page_id", F.col("_bytes").alias("payload_bytes"), F.col("_of").alias("payload_digest"), "record_type", "refers_to",
                               F.coalesce("fault", F.when(F.col("_of").isNull(), "no such response")).alias("fault"))
    return rows.where("record_type <> 'revisit'").drop("_digest").unionByName(resolved)
