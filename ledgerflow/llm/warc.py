"""WARC archives: one gzip member a record, written and read by tasks.

Writing: equal payloads are found by their SHA-1 (a minimum per digest with
map-side combining, then a join on the digest that adaptive execution can
split).  The record with the smallest page id is the ``response``; the others
are ``revisit`` records without a body that refer to it and keep its HTTP
Content-Length and payload digest.  Each task writes archives of at most about
``FILE_BYTES`` in the shared folder and reports them in the manifest.

Reading is sequential and incremental: bytes are inflated in steps, headers
and the Content-Length frame each record, the member must end with it, and
block and payload digests are computed as the bytes pass.

Defined results: null html is an empty payload; a null url has no target
header and reads back null; a null id is never referred to, and if all equal
payloads have null ids each is a response; rows that repeat the smallest id
are responses all; an empty table gives no archives and no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import new_folder, stage
from .files import new_file, one_task_each, open_input, open_output

FILE_BYTES = 64 << 20
STEP = 1 << 18
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record: a response, or a revisit if it refers to a page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(quote(c) if c < "!" or c == "%" or c == "\x7f" else c for c in url)))
    if page is not None:
        fields.append(("X-Page-Id", quote(page)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page", quote(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + CRLF + b"".join(f"{k}: {v}".encode("utf-8", "surrogatepass") + CRLF for k, v in fields) + CRLF
    return head + block + CRLF + CRLF


def gzip_member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class _Inflated:
    """The bytes of successive gzip members of a stream, inflated in steps."""

    def __init__(self, stream, step: int = STEP):
        self.stream, self.step = stream, step
        self.raw, self.ready, self.inflate = b"", bytearray(), None

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the file."""
        self.raw = self.raw or self.stream.read(self.step)
        self.inflate = zlib.decompressobj(31) if self.raw else None
        return self.inflate is not None

    def more(self) -> bool:
        """Inflate one step; False at the end of the member."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.raw or self.stream.read(self.step)
        self.raw = b""
        found = self.inflate.decompress(data, 4 * self.step)
        if not data and not found:
            raise EOFError("the file ends within a gzip member")
        self.ready += found
        if self.inflate.eof:
            self.raw = self.inflate.unused_data
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.ready.find(mark)) < 0:
            if not self.more():
                raise ValueError("a record ends within its headers")
        found = bytes(self.ready[:at])
        del self.ready[:at + len(mark)]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, as they come."""
        while n:
            if not self.ready and not self.more():
                raise ValueError("a record ends before its Content-Length")
            part = bytes(self.ready[:n])
            del self.ready[:len(part)]
            n -= len(part)
            if part:
                yield part


def _headers(data: bytes) -> dict[str, str]:
    found = {}
    for line in data.split(CRLF)[1:]:
        name, _, value = line.partition(b":")
        found[name.decode().strip().lower()] = value.decode("utf-8", "surrogatepass").strip()
    return found


def read_records(stream, payloads: bool = True, step: int = STEP) -> Iterator[dict]:
    """Records of one archive in order.  ``digests_match`` says whether block
    and (for responses) payload have the digests that the headers give."""
    source = _Inflated(stream, step)
    while source.next_member():
        head = source.until(CRLF + CRLF)
        if not head.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        fields = _headers(head)
        block, payload, http, kept, size = hashlib.sha1(), hashlib.sha1(), bytearray(), [], 0
        in_body = False
        for part in source.take(int(fields["content-length"])):
            block.update(part)
            if not in_body:
                http += part
                at = http.find(CRLF + CRLF)
                if at < 0:
                    continue
                in_body, part = True, bytes(http[at + 4:])
                del http[at:]
            payload.update(part)
            size += len(part)
            if payloads:
                kept.append(part)
        closing = b"".join(source.take(4))
        while source.more():
            pass
        if closing != CRLF + CRLF or source.ready:
            raise ValueError("a gzip member is not one whole record")
        revisit = fields["warc-type"] == "revisit"
        named = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        own = base64.b32encode(payload.digest()).decode()
        match = fields.get("warc-block-digest", "") in ("", "sha1:" + base64.b32encode(block.digest()).decode())
        page, target, other = fields.get("x-page-id"), fields.get("warc-target-uri"), fields.get("x-refers-to-page")
        yield {"page_id": None if page is None else unquote(page), "url": None if target is None else unquote(target),
               "record_type": fields["warc-type"], "payload_bytes": int(_headers(bytes(http))["content-length"]) if revisit else size,
               "payload_digest": named if revisit else own, "refers_to": None if other is None else unquote(other),
               "digests_match": match and (revisit or named == own),
               "payload": b"".join(kept) if payloads and not revisit else None}


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages; the manifest: file, n_records.  Equal payloads of at
    least ``min_bytes`` bytes are stored once."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.sha1(body).alias("sha"))
    firsts = (pages.select(F.col(id_col).alias("id"), F.sha1(body).alias("sha"), F.octet_length(body).alias("size"))
              .where(F.col("size") >= min_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select(F.col("sha").alias("first_sha"), "first"))
    marked = rows.join(firsts, F.col("sha") == F.col("first_sha"), "left").select(
        F.col("id").cast("string").alias("id"), "url", "html", "sha",
        F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, count, size = TaskContext.get().partitionId(), None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], names=["file", "n_records"])

        for batch in batches:
            for i, url, html, sha, refers_to in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "sha", "refers_to"))):
                if out is None:
                    path = new_file(folder, f"pages-{part:06d}", ".warc.gz")
                    out, count, size = open_output(path), 0, 0
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                data = gzip_member(record(i, url, (html or "").encode("utf-8", "surrogatepass"), digest, refers_to, date))
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return stage(marked.mapInArrow(write, "file string, n_records long"), "warc-files")


def read_archives(spark: SparkSession, manifest: DataFrame, id_type: str = "long", payloads: bool = True) -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, digests_match and, if asked for, payload."""
    fields = [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.string()), ("digests_match", pa.bool_())]
    fields += [("payload", pa.binary())] * payloads
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                held, size = [], 0
                with open_input(path) as stream:
                    for found in read_records(stream, payloads):
                        held.append(found)
                        size += len(found["payload"] or b"") + 300
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    types = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, digests_match boolean"
    found = one_task_each(manifest).mapInArrow(read, types + (", payload binary" if payloads else ""))
    return found.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))
