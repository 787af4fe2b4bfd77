"""WARC writer and salvage reader (operator 4).

The writer puts one record per page into archives of gzip members in the shared
folder, an archive being closed at about ``ARCHIVE_BYTES``; a payload that another
page has already (equal SHA-256 and length; the smallest page_id holds it) becomes
a revisit record.  File names carry the task attempt and only the files named in
the committed manifest are read, so a retried task leaves no half archive behind.

The salvage reader walks through an archive by random access.  A record counts
when its gzip member (or, in a plain archive, the record itself) is complete and
its version line, Content-Length and block digest agree.  After a failed check it
searches for the next gzip magic or version line, tries each in turn, goes on from
the first valid record and logs the bytes in between as one quarantined gap.  It
holds one record at a time.

Defined cases: null html is an empty payload; a null page_id is never the response
of a group that has another id; repeated rows of the response are responses too; a
null url is written as an empty target, a url of any length is read back; an empty table gives no archives; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import read_table, trimmed, written
from lapforge.session import scratch_path

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
SEARCH_BYTES = 1 << 20
VERSION = b"WARC/1."
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def store_uri(path: str) -> str:
    """The path with the store's own scheme in place of Hadoop's names of it."""
    return re.sub("^s3[an]://", "s3://", path)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """A file system that drivers and executors share, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    path = store_uri(path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, response_id: int | None,
           is_response: bool, date: str) -> bytes:
    """One record in bytes; a revisit keeps the HTTP head only."""
    digest = sha1(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode() + (payload if is_response else b"")
    target = " ".join((url or "").split())
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if not is_response:
        head += [f"WARC-Refers-To: {record_id(response_id, digest)}", f"WARC-Profile: {PROFILE}"]
        if response_id is not None:
            head.append(f"Refers-To-Page-ID: {response_id}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


MANIFEST = "path string, records long, bytes long"


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The manifest (path, records, bytes) of the archives written under ``folder``."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    key = [F.sha2(F.col("html").cast("binary"), 256).alias("sha"), F.octet_length("html").alias("size")]
    digests = rows.select("page_id", *key)
    first = digests.groupBy("sha", "size").agg(F.min("page_id").alias("response_id"),
                                               F.count(F.lit(1)).alias("copies")).where("copies > 1")
    revisits = digests.join(first, ["sha", "size"]) \
        .where(~F.col("page_id").eqNullSafe(F.col("response_id"))) \
        .select("page_id", "sha", "size", "response_id").distinct()
    tagged = rows.select("*", *key).alias("r").join(
        revisits.alias("v"), F.col("r.page_id").eqNullSafe(F.col("v.page_id"))
        & (F.col("r.sha") == F.col("v.sha")) & (F.col("r.size") == F.col("v.size")), "left") \
        .select("r.page_id", "r.url", "r.html", "v.response_id", F.col("v.sha").isNull().alias("is_response"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = open_fs(folder)
        system.create_dir(base, recursive=True)
        out, done, n, size = None, [], 0, 0

        def close() -> None:
            nonlocal out, n, size
            if out is not None:
                out.close()
                done[-1].update(records=n, bytes=size)
            out, n, size = None, 0, 0

        for batch in batches:
            for page_id, url, html, response_id, is_response in zip(
                    *(batch.column(i) for i in range(5)), strict=True):
                if out is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):05d}.warc.gz"
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    done.append({"path": f"{folder}/{name}"})
                data = member(record(page_id.as_py(), url.as_py(), html.as_py().encode(),
                                     response_id.as_py(), is_response.as_py(), date))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema(
                [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(tagged.mapInArrow(trimmed(run), MANIFEST), "warc-manifest")


class Bad(Exception):
    """A failed check; the text is the reason."""


class Salvage:
    """Records and gaps of one archive."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at)) if at < self.size else b""

    def member_at(self, at: int) -> tuple[bytes, int]:
        """(content, end) of the gzip member at ``at``."""
        d, out, pos = zlib.decompressobj(31), [], at
        while not d.eof:
            data = self.read(pos, READ_BYTES)
            if not data:
                raise Bad("truncated member")
            try:
                out.append(d.decompress(data))
            except zlib.error as e:
                raise Bad("damaged member") from e
            if len(out) == 1 and not out[0][:len(VERSION)].startswith(VERSION[:len(out[0])]):
                raise Bad("no version line")
            pos += len(data)
        return b"".join(out), pos - len(d.unused_data)

    def head_bytes(self, at: int) -> bytes:
        """The blocks from ``at`` on up to the one in which the record head ends."""
        data = bytearray()
        while block := self.read(at + len(data), READ_BYTES):
            seen = max(0, len(data) - 3)
            data += block
            if data.find(b"\r\n\r\n", seen) >= 0:
                break
        return bytes(data)

    @staticmethod
    def head(data: bytes) -> tuple[dict[str, str], int]:
        """(fields, length) of the record head at the start of ``data``."""
        end = data.find(b"\r\n\r\n")
        if not data.startswith(VERSION) or end < 0:
            raise Bad("no version line" if end >= 0 else "no end of header")
        fields = {}
        for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if not colon:
                raise Bad("bad header line")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise Bad("no content length")
        return fields, end + 4

    @staticmethod
    def checked(fields: dict[str, str], block: bytes, tail: bytes) -> tuple[dict[str, str], bytes]:
        if len(block) != int(fields["content-length"]) or tail != b"\r\n\r\n":
            raise Bad("wrong content length")
        kind, _, digest = fields.get("warc-block-digest", "").partition(":")
        if kind == "sha1" and digest != sha1(block):
            raise Bad("wrong block digest")
        return fields, block

    def record_at(self, at: int) -> tuple[dict[str, str], bytes, int]:
        """(fields, block, end) of the record at ``at``."""
        start = self.read(at, len(VERSION))
        if start.startswith(MAGIC):
            data, end = self.member_at(at)
            fields, n = self.head(data)
            return *self.checked(fields, data[n:-4], data[-4:]), end
        if start != VERSION:
            raise Bad("neither member nor version line")
        fields, n = self.head(self.head_bytes(at))
        length = int(fields["content-length"])
        if at + n + length + 4 > self.size:
            raise Bad("truncated record")
        data = self.read(at + n, length + 4)
        return *self.checked(fields, data[:length], data[length:]), at + n + length + 4

    def next_start(self, at: int) -> int:
        """The next place from ``at`` on that looks like a member or a version line."""
        while at < self.size:
            data = self.read(at, SEARCH_BYTES)
            found = [k for k in (data.find(MAGIC), data.find(VERSION)) if k >= 0]
            if found:
                return at + min(found)
            if at + len(data) >= self.size:
                break
            at += len(data) - len(VERSION) + 1
        return self.size

    def __iter__(self) -> Iterator[tuple]:
        """("record", offset, length, fields, block) and ("gap", offset, length, reason, None)."""
        at, gap, why = 0, None, ""
        while at < self.size:
            try:
                fields, block, end = self.record_at(at)
            except Bad as e:
                if gap is None:
                    gap, why = at, str(e)
                at = self.next_start(at + 1)
                continue
            if gap is not None:
                yield "gap", gap, at - gap, why, None
                gap = None
            yield "record", at, end - at, fields, block
            at = end
        if gap is not None:
            yield "gap", gap, self.size - gap, why, None


READ = ("kind string, path string, at long, bytes long, reason string, page_id long, payload_bytes long, "
        "payload_digest string, record_type string, refers_to long, url string, payload binary")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps (column ``kind``) of the archives in a manifest."""
    files = max(1, manifest.count())
    names = [f.split()[0] for f in READ.split(", ")]

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
                 pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = open_fs(path)
                with system.open_input_file(inner) as file:
                    for kind, at, size, info, block in Salvage(file, file.size()):
                        if kind == "gap":
                            rows.append((kind, path, at, size, info, *[None] * 7))
                        else:
                            head, _, payload = block.partition(b"\r\n\r\n")
                            length = next((x.split(b":")[1] for x in head.split(b"\r\n")
                                           if x.lower().startswith(b"content-length:")), b"0")
                            rows.append((kind, path, at, size, None, number(info.get("page-id")), int(length),
                                         info.get("warc-payload-digest", "").partition(":")[2],
                                         info.get("warc-type"), number(info.get("refers-to-page-id")),
                                         info.get("warc-target-uri"), payload if with_payload else None))
                            held += len(payload)
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield flush()
                            rows, held = [], 0
        if rows:
            yield flush()

    return manifest.select("path").repartition(files).mapInArrow(trimmed(run), READ)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    manifest = write_archives(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(manifest, with_payload=False).where(F.col("kind") == "record").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
b AS (
  SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5))::BIGINT) AS parts
  FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((parts[CAST(i // 4 + 1 AS BIGINT)] >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b
"""
