"""Operator 5: WARC archives of pages, written and read back as a chunked record table.

Writing: every page is a record of WARC/1.1, its block an HTTP response with the page as payload, each record a gzip
member of its own. Of pages with equal payloads (SHA-1 and length) of at least `revisit_bytes` the one with the smallest
page_id is written as `response`, the others as `revisit` records that refer to it and have no payload. A payload is
digested and compressed in pieces of CHUNK_BYTES.

Reading: an archive is decompressed as a stream and becomes rows (record, chunk number, chunk) with the payload digest of
the chunks so far; the last chunk of a record has its whole digest, which must agree with the record's header. No step
holds a whole payload besides the input row itself.

Defined results: null pages have an empty payload; with revisit_bytes 0 empty payloads are revisited like others; pages
without page_id come after all others, and rows that share the smallest page_id of a payload are all responses; a null url leaves the header out; an empty table gives an
empty result; other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CHUNK_BYTES = 1 << 20
#: An archive file is closed when it has this many bytes.
ARCHIVE_BYTES = 128 << 20
#: Chunk rows handed to Spark at a time, by bytes.
BATCH_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"


def with_roles(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_bytes, sha1 (hex) and refers_to (null for responses).

    Only payloads that occur more than once are joined back, on a unique key; they are written first, so that their size
    is known when the join is planned."""
    rows = C.text_rows(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn(
        "sha1", F.sha1(F.col("html").cast("binary")))
    first = rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("sha1", "payload_bytes").agg(
        F.min("page_id").alias("first_page"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = C.written(first, "repeated-payloads")
    return rows.join(first, ["sha1", "payload_bytes"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page"))).drop("first_page")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _uri(text: str) -> str:
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


class ArchiveWriter:
    """Writes records to one archive file."""

    def __init__(self, uri: str, date: str):
        self.uri, self.date, self.out = uri, date, C.open_output(uri)
        self.bytes = self.records = 0

    def _send(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def record(self, page_id: int | None, url: str | None, payload: memoryview, refers_to: int | None) -> None:
        digest = hashlib.sha1()
        for at in range(0, len(payload), CHUNK_BYTES):
            digest.update(payload[at:at + CHUNK_BYTES])
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        kind = "response" if refers_to is None else "revisit"
        body = len(payload) if refers_to is None else 0
        head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <{RECORD}{'' if page_id is None else page_id}>",
                f"WARC-Date: {self.date}", f"WARC-Payload-Digest: sha1:{base32(digest.digest())}",
                "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + body}"]
        if url is not None:
            head.append(f"WARC-Target-URI: {_uri(url)}")
        if refers_to is not None:
            head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._send(pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http))
        for at in range(0, body, CHUNK_BYTES):
            self._send(pack.compress(payload[at:at + CHUNK_BYTES]))
        self._send(pack.compress(b"\r\n\r\n") + pack.flush())
        self.records += 1

    def close(self) -> None:
        self.out.close()


def write_archives(pages: DataFrame, folder: str, *, revisit_bytes: int = 0,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the archives under `folder` (a URI that all executors reach) and return the manifest (file, records, bytes), a
    written table. Files that a lost task left behind are in no manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []

        def close():
            out.close()
            done.append((out.uri, out.records, out.bytes))

        for batch in batches:
            body, offsets = C.utf8_column(batch.column(2))
            raw = memoryview(body)
            ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, page_id in enumerate(ids):
                if out is None:
                    out = ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.warc.gz", date)
                out.record(page_id, urls[i], raw[offsets[i]:offsets[i + 1]], refers[i])
                if out.bytes >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["file", "records", "bytes"])

    rows = with_roles(pages, revisit_bytes).select("page_id", "url", "html", "refers_to")
    return C.written(rows.mapInArrow(write, "file string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Decompressed bytes of an archive, read piece by piece."""

    def __init__(self, file):
        self.file, self.held, self.z = file, b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.z.eof:
            rest = self.z.unused_data
            self.z = zlib.decompressobj(31)
        else:
            rest = self.z.unconsumed_tail
        data = rest or self.file.read(1 << 16)
        if not data:
            return False
        self.held += self.z.decompress(data, CHUNK_BYTES)
        return True

    def lines_to_blank(self) -> list[str] | None:
        """The lines before an empty line; None at the archive's end."""
        while b"\r\n\r\n" not in self.held:
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a header")
                return None
        head, _, self.held = self.held.partition(b"\r\n\r\n")
        return head.decode().split("\r\n")

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_archive(uri: str) -> Iterator[tuple]:
    """Rows of the chunked record table: page_id, url, record_type, refers_to, payload_bytes (of the whole payload), chunk_no,
    chunk, digest (base32 SHA-1 of the payload up to here; a revisit's own), last."""
    with C.open_input(uri) as file:
        stream = _Stream(file)
        while (lines := stream.lines_to_blank()) is not None:
            head = _fields(lines)
            http_lines = stream.lines_to_blank()
            http = _fields(http_lines)
            name = head["warc-record-id"].strip("<>").removeprefix(RECORD)
            refers = head.get("warc-refers-to", "").strip("<>").removeprefix(RECORD)
            stated = head["warc-payload-digest"].removeprefix("sha1:")
            size = int(http["content-length"])
            base = (int(name) if name else None, head.get("warc-target-uri"), head["warc-type"],
                    int(refers) if refers else None, size)
            left = int(head["content-length"]) - len("\r\n".join(http_lines).encode()) - 4
            if head["warc-type"] == "revisit":
                stream.take(left + 4)
                yield (*base, 0, b"", stated, True)
                continue
            digest, number = hashlib.sha1(), 0
            while True:
                chunk = stream.take(min(left, CHUNK_BYTES))
                left -= len(chunk)
                digest.update(chunk)
                so_far = base32(digest.copy().digest())
                if left == 0 and so_far != stated:
                    raise ValueError(f"record {name} of {uri} does not have its stated digest")
                yield (*base, number, chunk, so_far, left == 0)
                number += 1
                if left == 0:
                    break
            stream.take(4)


TABLE = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, chunk_no int, chunk binary, "
         "payload_digest string, last boolean")


def record_table(manifest: DataFrame) -> DataFrame:
    """The chunked record table of all archives."""
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.bool_())
    names = [x.split()[0] for x in TABLE.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in read_archive(uri):
                    rows.append(row)
                    held += len(row[6]) + 200
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    files = manifest.select("file").repartition(C.shuffle_partitions(manifest.sparkSession))
    return files.mapInArrow(read, TABLE)


def round_trip(pages: DataFrame, *, revisit_bytes: int = 0) -> DataFrame:
    """Write archives into the shared folder, read them into a written chunk table, and return one row per record."""
    folder = C.scratch_path(pages.sparkSession, "warc")
    table = C.written(record_table(write_archives(pages, folder, revisit_bytes=revisit_bytes)), "warc-records")
    return table.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
