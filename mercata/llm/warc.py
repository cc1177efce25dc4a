"""WARC archives: pages written as response and revisit records, read back and put together.

Writing: of the pages with equal payloads of at least ``REVISIT_BYTES`` the one with the smallest
id is the response, the others revisit it. Digests are counted with map-side minima and joined
back, and Spark splits the join's hot digests. A response holds an HTTP message in chunked transfer framing;
a block above ``SEGMENT_BYTES`` is continued in further records. Spark's text writer writes the
archives, with the blank lines that end a WARC record as its line end: tasks that are run again leave
no broken archive, and any store that Spark knows will do. Pages are cut at character ends.

Reading: each archive is inflated and parsed in pieces by one task, which hands records on as it finds
them: it holds the compressed file (at most 2 GB, Spark's limit for a value), a few megabytes of what is inflated,
and one record. An archive written here has at most ``RECORDS_PER_FILE`` records of about ``SEGMENT_BYTES``. Continuation records are grouped by the id of their
first record, ordered by segment number, checked against the total length, and decoded; a group is
one record, so its size is that of a page. A payload that differs from its digest stops the job.

A null page is an empty payload. A page without an id has no id when read back and never is
what others refer to. Repeated rows of the smallest id are all responses.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.common import read_table
from mercata.session import scratch_path

REVISIT_BYTES = 100
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 20_000
READ_BYTES = 65_536  # of a compressed archive that are inflated at a time
PIECE_BYTES = 1 << 20  # inflated bytes at a time
BATCH_BYTES = 4 << 20  # of blocks that a task hands on at a time, or one block
BATCH_RECORDS = 5_000
END = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RAW = "origin string, number int, total long, id string, type string, refers_to string, digest string, bytes long, block binary"


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, url, payload, digest and ``refers_to`` (the response's id, null for responses)."""
    rows = pages.select(
        pages[id_col].alias("id"),
        pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.encode("payload", "utf-8"), 256))
    firsts = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(firsts, "digest", "left").select("id", "url", "payload", "digest", refers.alias("refers_to"))


def cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of at most ``size`` bytes (at least 4) that end between UTF-8 characters."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and end > start + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[start:end]
        start = end


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in cuts(payload, CHUNK_BYTES)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Chunked transfer framing undone; raises ValueError where it is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = [f"{k}: {re.sub(r'[\x00-\x20\x7f]+', '%20', str(v))}" for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + END + block


def page_records(page, url, payload: bytes, digest: str, refers_to, name: str) -> Iterator[bytes]:
    shared = [("WARC-Target-URI", url), ("X-Page-ID", page), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        kind = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Profile", REVISIT_PROFILE)]
        more = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("X-Payload-Length", len(payload))]
        yield record(kind + shared + more, HTTP_HEAD + b"\r\n")
        return
    block = HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = list(cuts(block, SEGMENT_BYTES))
    for number, part in enumerate(parts, 1):
        kind = [("WARC-Type", "response" if number == 1 else "continuation")]
        kind.append(("WARC-Record-ID", f"<{name}>" if number == 1 else f"<{name}.{number}>"))
        if len(parts) > 1:
            kind.append(("WARC-Segment-Number", number))
        if number > 1:
            kind.append(("WARC-Segment-Origin-ID", f"<{name}>"))
            if number == len(parts):
                kind.append(("WARC-Segment-Total-Length", len(block)))
        yield record(kind + (shared if number == 1 else []), part)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page, url, payload, digest, refers_to = values
                out += page_records(page, url, payload.encode(), digest, refers_to, f"urn:page:{page}:{task}.{row}")
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])

    rows = with_revisits(pages, id_col, url_col, html_col)
    writer = rows.mapInArrow(run, "value string").write.option("lineSep", END.decode())
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)


def parsed(archive: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, plain or compressed: headers in lower case, and the block. One piece and one
    record are held at a time."""
    pieces = inflated(memoryview(archive))
    held, gone = bytearray(), 0  # bytes not handed on yet, and how many were

    def holds(n: int) -> bool:
        while len(held) < n and (piece := next(pieces, None)) is not None:
            held.extend(piece)
        return len(held) >= n

    while holds(1):
        end = held.find(END)
        while end < 0 and holds(len(held) + 1):
            end = held.find(END)
        lines = held[: max(end, 0)].decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {gone}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = end + len(END)
        stop = start + int(headers["content-length"])
        if not holds(stop + len(END)) or held[stop : stop + len(END)] != END:
            raise ValueError(f"record at byte {gone} is cut short")
        with memoryview(held) as view:
            block = bytes(view[start:stop])
        del held[: stop + len(END)]
        gone += stop + len(END)
        yield headers, block


def inflated(data: memoryview) -> Iterator[bytes | memoryview]:
    """The bytes of a plain file, or of all members of a gzip file, in pieces of at most ``PIECE_BYTES``.

    Archives have a member for each record or one in all. A member that is cut short raises ValueError.
    """
    if bytes(data[:2]) != b"\x1f\x8b":
        for at in range(0, len(data), PIECE_BYTES):
            yield data[at : at + PIECE_BYTES]
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        rest: bytes | memoryview = b""
        while not member.eof:
            if not rest:
                rest = data[at : at + READ_BYTES]
                at += len(rest)
                if not rest:
                    raise ValueError("archive is cut short")
            yield member.decompress(rest, PIECE_BYTES)
            rest = member.unconsumed_tail
        at -= len(member.unused_data)


def payload_of(block: bytes, digest: str) -> bytes:
    """The payload of an HTTP message; raises ValueError if it differs from the digest."""
    head, _, body = block.partition(END)
    payload = unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload differs from its digest")
    return payload


def raw_records(spark: SparkSession, path: str, *, settle: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``. With ``settle`` a response in one record is
    checked against its digest on the spot and keeps its payload's size instead of its block."""

    def run(batches):
        names = ["origin", "number", "total", "id", "type", "refers_to", "digest", "bytes", "block"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        def handed_on(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows, weight = [], 0
        for batch in batches:
            for archive in batch.column(0):
                for h, block in parsed(archive.as_buffer()):
                    number, total, size = (h.get(k) for k in ("warc-segment-number", "warc-segment-total-length", "x-payload-length"))
                    if settle and number is None and h["warc-type"] == "response":
                        size, block = len(payload_of(block, h["warc-payload-digest"].removeprefix("sha256:"))), None
                    row = (
                        h.get("warc-segment-origin-id", h["warc-record-id"]).strip("<>"),
                        number and int(number),
                        total and int(total),
                        h.get("x-page-id"),
                        h["warc-type"],
                        h["warc-refers-to"].strip("<>").removeprefix("urn:page:") if "warc-refers-to" in h else None,
                        h.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                        size if size is None else int(size),
                        block,
                    )
                    rows.append(row)
                    weight += len(block or b"")
                    if weight >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                        yield handed_on(rows)
                        rows, weight = [], 0
        if rows:
            yield handed_on(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RAW)


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per page: page_id (text), payload_bytes, payload_digest, record_type, refers_to
    (text) and, unless left out, the payload (null for revisits)."""

    def run(batches):
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for parts in batch.column(0).to_pylist():
                first, payload = parts[0], None
                size = first["bytes"]
                if first["type"] == "response" and first["block"] is not None:
                    payload = payload_of(joined(parts), first["digest"])
                    size = len(payload)
                row = (first["id"], size, first["digest"], first["type"], first["refers_to"], payload)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns[: 5 + with_payload], names[: 5 + with_payload])

    part = F.struct(F.coalesce("number", F.lit(1)).alias("number"), "total", "id", "type", "refers_to", "digest", "bytes", "block")
    groups = raw_records(spark, path, settle=not with_payload).groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return groups.select("parts").mapInArrow(run, schema + ", payload binary" * with_payload)


def joined(parts: list[dict]) -> bytes:
    """The block of a record from its segments; raises ValueError unless they are all there."""
    if [p["number"] for p in parts] != [*range(1, len(parts) + 1)]:
        raise ValueError(f"segments {[p['number'] for p in parts]} of {parts[0]['id']}")
    block = b"".join(p["block"] for p in parts)
    if len(parts) > 1 and parts[-1]["total"] != len(block):
        raise ValueError(f"{len(block)} bytes of {parts[-1]['total']}")
    return block


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY body) END AS first FROM p
)
SELECT page_id, payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    rows = read_archives(spark, path, with_payload=False)
    return rows.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))
