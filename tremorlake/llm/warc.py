"""WARC archives: written from pages, and read back as a table of chunks.

Reading streams each archive. A payload becomes rows of a record identifier and a chunk
number; each row carries the digest and the length so far, so the row with ``last`` set
has those of the whole payload and nothing has to be gathered. No record is ever held
whole by the reader, only one chunk.

Of pages with equal payloads the one with the smallest id is written as a response, the
others as revisits that name it. Cases: a null payload is an empty one, and empty
payloads are equal too; a null id comes after all others, and if all ids of a payload
are null, all of its rows are responses; rows that repeat the response's own id are
responses as well, as a record can't refer to itself; null URLs are written as empty;
an empty table gives no archive; extra columns are left behind.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.shards import new_file, open_at, qualified, segments
from tremorlake.session import cut_lineage, new_path

CHUNK = 1 << 20
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = (
    "record_id string, record_type string, page_id bigint, url string, refers_to bigint, payload_digest string, "
    "payload_bytes bigint, chunk_no int, chunk binary, bytes_so_far bigint, sha1_so_far string, last boolean"
)
PLACES = "path string, page_id bigint, record_type string, offset bigint"


def base32(digest: Column) -> Column:
    """A hexadecimal SHA-1 in bare upper-case base32: ten hexadecimal digits are eight digits to base 32."""
    groups = [F.lpad(F.conv(F.substring(digest, n, 10), 16, 32), 8, "0") for n in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def classified(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``: refers_to is set for revisits.

    Only digests and ids are grouped, with partial sums before the shuffle; only payloads
    met more than once are kept for the join, which a hot payload can't overload as
    adaptive execution splits it.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", base32(F.sha1("payload")))
    counted = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("payload_digest")
    shared = counted.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = cut_lineage(shared.filter("first is not null").select("payload_digest", "first"), "first-pages")
    joined = rows.join(firsts, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(revisit, F.col("first")).alias("refers_to"))


def _record_id(kind: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{kind}|{page_id}|{digest}'.encode()).hexdigest())}>"


def _one_line(url: str) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url)


def _write_record(out: IO[bytes], page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> None:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = len(payload) if refers_to is None else 0
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(kind, page_id, digest)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + body)),
    ]
    if refers_to is not None:
        fields[-1:-1] = [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id("response", refers_to, digest)),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0) as member:
        member.write(head.encode())
        member.write(http)
        view = memoryview(payload)
        for first in range(0, body, CHUNK):
            member.write(view[first : first + CHUNK])
        member.write(b"\r\n\r\n")


class _Counted:
    """A stream that knows how much was written to it."""

    def __init__(self, out: IO[bytes]):
        self.out, self.size = out, 0

    def write(self, data) -> int:
        self.size += len(data)
        return self.out.write(data)

    def flush(self) -> None:
        pass


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """One archive per task, one gzip member per record; returns the stored table of places."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def rest():
            yield first
            yield from batches

        with new_file(folder, ".warc.gz") as (path, file):
            out = _Counted(file)
            for batch in rest():
                columns = [batch.column(n) for n in range(5)]
                places = []
                for n in range(batch.num_rows):
                    page_id, url, payload, digest, refers_to = (c[n].as_py() for c in columns)
                    places.append((path, page_id, "response" if refers_to is None else "revisit", out.size))
                    _write_record(out, page_id, url, payload, digest, refers_to)
                types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*places), types)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "page_id", "record_type", "offset"])

    folder = qualified(pages.sparkSession, folder)
    ordered = classified(pages).select("page_id", "url", "payload", "payload_digest", "refers_to")
    return cut_lineage(ordered.mapInArrow(write, PLACES), "warc-places")


def _records(path: str, begin: int = 0, most: int | None = None) -> Iterator[tuple]:
    """Rows of CHUNKS of the records of one archive, from an offset at which one begins, all of them or so many."""
    with open_at(path) as raw:
        raw.seek(begin)
        stream = gzip.GzipFile(fileobj=raw, mode="rb")
        met = 0
        while met != most and (line := stream.readline()):
            if line == b"\r\n":
                continue
            met += 1
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: a record doesn't start with its version")
            fields = {}
            while (line := stream.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                fields[name.lower()] = value.strip()
            left = int(fields["content-length"])
            length = 0
            while left and (line := stream.readline()) != b"\r\n":
                left -= len(line)
                name, _, value = line.decode().partition(":")
                if name.lower() == "content-length":
                    length = int(value)
            left -= 2
            number = lambda name: int(fields[name]) if fields.get(name) else None
            head = (
                fields["warc-record-id"],
                fields["warc-type"],
                number("page-id"),
                fields["warc-target-uri"],
                number("refers-to-page-id"),
                fields["warc-payload-digest"].partition(":")[2],
                length,
            )
            digest, seen, chunk_no = hashlib.sha1(), 0, 0
            while True:
                chunk = stream.read(min(CHUNK, left)) if left else b""
                if left and not chunk:
                    raise ValueError(f"{path}: a record ends too early")
                left -= len(chunk)
                digest.update(chunk)
                seen += len(chunk)
                yield (*head, chunk_no, chunk, seen, digest.hexdigest(), not left)
                chunk_no += 1
                if not left:
                    break


def read_chunks(places: DataFrame) -> DataFrame:
    """Every record of the archives that the places name, as rows of chunks; long archives are read in parts.

    ``payload_digest`` and ``payload_bytes`` are what the record's headers say of the full
    payload; ``sha1_so_far`` and ``bytes_so_far`` are counted while reading. A revisit has
    one empty chunk.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n.split()[0] for n in CHUNKS.split(", ")]
        types = [pa.string()] * 2 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
        types += [pa.binary(), pa.int64(), pa.string(), pa.bool_()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

        for part in batches:
            for path, begin, most in zip(*(part.column(n).to_pylist() for n in range(3))):
                rows, size = [], 0
                for row in _records(path, begin, most):
                    rows.append(row)
                    size += len(row[8]) + 512
                    if size >= 4 * CHUNK:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return segments(places, []).mapInArrow(read, CHUNKS)


def op5_warc(spark, sf_dir):
    """Every page's record, written to archives and read back: its type, its payload's bytes and digest, what it refers to.

    A null payload is an empty one; an empty table gives no row.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    chunks = read_chunks(write_warc(pages, new_path(spark, "warc")))
    response = F.col("record_type") == "response"
    # What was counted while reading stands for responses; a revisit has no payload of its own.
    return chunks.filter("last").select(
        "page_id",
        F.when(response, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, base32(F.col("sha1_so_far"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
