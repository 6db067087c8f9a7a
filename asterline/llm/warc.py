"""WARC archives: one gzip member for each record, written by tasks and read back in sequence.

A payload is written in full once: of the records with equal payloads the one with the largest id is the response, the
others are revisits that name it. The reader takes one member at a time, inflates it in pieces, frames
the block by its content length and verifies block and payload digests; a bad record is an error.

Null html is an empty payload. A null id is written without an id and refers to nothing; if a payload has only
null ids, all of them are responses. A null address is left out. An empty table gives no archive and no rows.
Equal pages (also in id) are separate records: one row with the largest id is the response, its exact repeats revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.llm.files import contents, whole_file
from asterline.session import scratch, stored

ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 16
VERSION = b"WARC/1.1"
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class BadRecord(ValueError):
    pass


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def encoded(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member. The block of a revisit is the head of the response, without its payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response")]
    if page_id is not None:
        fields.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def members(archive: bytes) -> Iterator[bytes]:
    """The inflated members of an archive, one after another; input goes in in pieces."""
    view, at = memoryview(archive), 0
    while at < len(view):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise BadRecord("the archive ends inside a record")
            piece = view[at : at + PIECE]
            out.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(out)


def decoded(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block; framing and block digest are verified."""
    end = member.find(b"\r\n\r\n")
    lines = member[: max(end, 0)].split(b"\r\n")
    if end < 0 or lines[0] != VERSION:
        raise BadRecord("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    block = member[end + 4 : end + 4 + size]
    if len(block) != size or member[end + 4 + size :] != b"\r\n\r\n":
        raise BadRecord("the block does not end where its length says")
    if fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise BadRecord("the block does not match its digest")
    return fields, block


def _number(uri: str | None) -> int | None:
    return int(uri.strip("<>").rpartition(":")[2]) if uri else None


def parsed(member: bytes) -> tuple:
    """One record as a row of RECORD."""
    fields, block = decoded(member)
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, sha = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != stated or digest(payload) != sha):
        raise BadRecord("the payload does not match its digest")
    if kind == "revisit" and payload:
        raise BadRecord("a revisit with a payload")
    return (_number(fields.get("warc-record-id")), fields.get("warc-target-uri"), stated, sha, kind,
            _number(fields.get("warc-refers-to")))


def write(pages: DataFrame, folder: str, ident: str = "page_id", url: str = "url", html: str = "html",
          least: int = 0) -> DataFrame:
    """Archive all pages; payloads under `least` bytes are never revisits. Returns the manifest (archive, records, bytes)."""
    rows = pages.select(F.col(ident).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    # Only payloads met more than once; counts are combined before the shuffle, so a common payload is one row of each task.
    shared = (
        rows.where(F.octet_length("payload") >= least).groupBy("sha")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("times"), F.count_if(F.col("page_id").isNotNull()).alias("known"))
        .where("times > 1 AND known > 0").select("sha", "first")
    )
    joined = rows.join(shared, "sha", "left").drop("sha").sortWithinPartitions("page_id", "url")

    def archive(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, buffer, size, made = TaskContext.get().partitionId(), 0, [], 0, []

        def flush():
            name = f"pages-{part:06d}-{number:04d}.warc.gz"
            with whole_file(f"{folder}/{name}") as out:
                for x in buffer:
                    out.write(x)
            made.append((name, len(buffer), size))

        held = None
        for batch in batches:
            for page_id, address, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = first is not None and (page_id != first or held == first)
                held = page_id if first is not None else held
                buffer.append(encoded(page_id, address, payload, first if revisit else None, revisit))
                size += len(buffer[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
                    number, buffer, size = number + 1, [], 0
        if buffer:
            flush()
        yield pa.RecordBatch.from_pylist([{"archive": a, "records": n, "bytes": b} for a, n, b in made], schema=pa.schema(
            [("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return stored(joined.mapInArrow(archive, "archive string, records long, bytes long"), "warc-manifest")


def read(spark, folder: str) -> DataFrame:
    """Every record of the archives of a folder, verified."""

    def records(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD.split(", ")])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], names=names)

        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for member in members(content.as_py()):
                    rows.append(parsed(member))
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return contents(spark, folder).select("content").mapInArrow(records, RECORD)


def archived(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write all pages and read them back: one row of RECORD for each page."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    if write(pages, folder, ident, url, html, least).isEmpty():
        return spark.createDataFrame([], RECORD)
    return read(spark, folder)
