"""WARC archives: writing records in segments, and reassembling them.

A page becomes an HTTP response, framed in chunks, in a WARC/1.1 record. A block over the segment size goes on in
continuation records, which name the first record, count up, and give the total length in the last one. A payload that an
earlier page has becomes a revisit of that page's record. Every record is one row of Spark's text writer with CRLF CRLF
as the row separator, which is what ends a WARC record; so each part file is an archive.

Reading takes archives as binary files, bounded in size by the writer, and walks the records by their Content-Length.
Segments are grouped by origin, ordered by number, joined and checked against the total length; then chunks are
decoded and the payload's digest is computed again and compared.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import checkpointed, shared_folder, small_side

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_RECORD = "kind string, id string, page_id long, uri string, digest string, refers_to long, origin string, number int, segmented boolean, total long, block binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """A body in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        out.append(body[at : at + size])
        if len(out[-1]) < size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n" + block.decode("utf-8", "surrogatepass")


def _clean(uri: str | None) -> str | None:
    return uri if uri is None else "".join(c if c > "\x1f" and c != "\x7f" else f"%{ord(c):02X}" for c in uri)


def _segments(block: bytes, size: int) -> Iterator[bytes]:
    """Parts of about so many bytes, cut between characters."""
    at = 0
    while True:
        end = at + size
        while end < len(block) and block[end] & 0xC0 == 0x80:
            end += 1
        yield block[at:end]
        at = end
        if at >= len(block):
            return


def _records(batches: Iterator[pd.DataFrame], segment: int, chunk: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row in batch.itertuples():
            page = None if pd.isna(row.page_id) else int(row.page_id)
            common = [("WARC-Target-URI", _clean(row.url)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{row.digest}"), ("X-Page-ID", page)]
            new_id = lambda: f"<urn:uuid:{uuid.uuid4()}>"
            if not pd.isna(row.refers_to):
                out.append(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", new_id()), *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", int(row.refers_to))], b""))
                continue
            block = _HTTP.encode() + chunked_text(row.payload or b"", chunk)
            parts, origin = list(_segments(block, segment)), new_id()
            first = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *common, ("Content-Type", "application/http; msgtype=response")]
            if len(parts) > 1:
                first.append(("WARC-Segment-Number", 1))
            out.append(_record(first, parts[0]))
            for number, part in enumerate(parts[1:], 2):
                total = len(block) if number == len(parts) else None
                out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", new_id()), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)], part))
        yield pd.DataFrame({"value": out})


def chunked_text(payload: bytes, size: int) -> bytes:
    """chunked(), with chunks that end between characters, as the text writer needs."""
    parts = [p for p in _segments(payload, size) if p]
    return b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def write(pages: DataFrame, path: str, min_payload: int = 0, segment: int = 16 << 10, chunk: int = 4 << 10) -> None:
    """Write an archive for each partition of pages (page_id, url, html); null html is an empty payload.

    Of the rows with equal payloads of min_payload bytes or more, those with the smallest page_id are responses and the others
    revisit it; rows without page_id, and smaller payloads, are responses.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    sha1 = F.unhex(F.sha1("payload"))
    named = pages.withColumn("sha1", sha1)
    first = named.filter(F.length("payload") >= min_payload).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("page_id").alias("n")).filter("n > 1").select("sha1", "first")
    joined = named.join(small_side(checkpointed(first), 96), "sha1", "left").withColumn("refers_to", F.expr("if(page_id > first, first, null)"))
    rows = joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), _base32("sha1").alias("digest"), "refers_to")
    records = rows.mapInPandas(partial(_records, segment=segment, chunk=chunk), "value string")
    records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 2000).option("compression", "gzip").text(path)


def _base32(column: str) -> F.Column:
    """Base 32 of 20 bytes, five bits a letter."""
    digits = F.concat(*(F.lpad(F.conv(F.hex(F.substring(column, i, 5)), 16, 32), 8, "0") for i in (1, 6, 11, 16)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def parse(archive: bytes) -> Iterator[dict]:
    """The records of an archive, walked by their Content-Length."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        start = end + 4
        at = start + int(fields["content-length"])
        if archive[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} does not end where it says")
        yield fields | {"block": bytes(view[start:at])}
        at += 4


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    whole = lambda x: None if x is None else int(x)
    for batch in batches:
        for content in batch.content:
            archive = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            out = [
                (r["warc-type"], r["warc-record-id"], whole(r.get("x-page-id")), r.get("warc-target-uri"), (r.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                 whole(r.get("x-refers-to-page-id")), r.get("warc-segment-origin-id") or r["warc-record-id"], int(r.get("warc-segment-number", 1)), "warc-segment-number" in r, whole(r.get("warc-segment-total-length")), r["block"])
                for r in parse(archive)
            ]
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _RECORD.split(", ")])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "total": "Int64"})


def _payloads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        payloads = []
        for blocks, total, numbers, digest in zip(batch.blocks, batch.total, batch.numbers, batch.digest, strict=True):
            block = b"".join(blocks)
            if list(numbers) != list(range(1, len(numbers) + 1)) or (len(numbers) > 1 and len(block) != total):
                raise ValueError(f"segments {list(numbers)} with {len(block)} bytes, not {total}")
            head, _, body = block.partition(b"\r\n\r\n")
            payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            if sha1_base32(payload) != digest:
                raise ValueError("the payload does not have its digest")
            payloads.append(payload)
        yield batch[["page_id", "uri", "digest"]].assign(payload=payloads)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The archives in a folder -> page_id, uri, digest, record_type, refers_to, payload (null for revisits)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    records = checkpointed(files.mapInPandas(_parsed, _RECORD))  # walked once, though three plans read them
    alone = records.filter("kind != 'revisit' AND NOT segmented").select("page_id", "uri", "digest", "total", F.array("number").alias("numbers"), F.array("block").alias("blocks"))
    # only records in several segments are shuffled
    segments = records.filter("segmented").groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("number", "block", "total", "page_id", "uri", "digest"))).alias("s"))
    whole = segments.select(
        F.expr("s[0].page_id").alias("page_id"), F.expr("s[0].uri").alias("uri"), F.expr("s[0].digest").alias("digest"), F.expr("s[size(s) - 1].total").alias("total"),
        F.expr("s.number").alias("numbers"), F.expr("s.block").alias("blocks"),
    )
    responses = alone.union(whole).mapInPandas(_payloads, "page_id long, uri string, digest string, payload binary")
    revisits = records.filter("kind = 'revisit'").select("page_id", "uri", "digest", F.lit("revisit").alias("record_type"), "refers_to", F.lit(None).cast("binary").alias("payload"))
    return responses.select("page_id", "uri", "digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "payload").union(revisits)


def round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write pages to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row for each row, repeated rows included; a revisit's payload_bytes are those of the response it names.
    """
    path = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write(pages, path, min_payload)
    records = checkpointed(read(pages.sparkSession, path).select("page_id", F.length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"))
    known = records.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("known_bytes")).dropDuplicates(["refers_to", "payload_digest"])
    joined = records.join(known, ["refers_to", "payload_digest"], "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "known_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
