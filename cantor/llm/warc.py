"""WARC archives as a chunked record table.

Writing: each page is a record, its payload the page's text in UTF-8. Of records with equal payloads the one with the
largest id is a response, the others are revisits that name it. Archives are gzip files with a member per
record, rolled at ROLL bytes. A payload is read in slices of CHUNK bytes from the Arrow batch it came in, for its digest and
for its member, and never copied whole. Archives are written straight to the shared folder: under a name of the attempt's own, listed only
by the rows of the attempt that succeeds.

Reading: an archive is a stream. A record's header is parsed, its payload comes as rows of (record, chunk number,
at most CHUNK bytes), each with the SHA-1 of the payload up to its end, so that the last chunk's digest is
the payload's and no record is ever held whole. A digest that differs from the header's is an error.

Defined results: a null payload is empty; empty payloads are equal to each other. Rows that repeat the winning id
are all responses. Null ids never win over others; where all ids of a payload are null, all are responses. An empty
table gives no archive and no row. Null urls are written as 'urn:none'. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize, scratch, short_batches, store

CHUNK = 256 * 1024
ROLL = 64 * 1024 * 1024
#: Bytes asked of a store at a time.
READ = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNKS = "archive string, record_id string, record_type string, refers_to string, chunk int, start long, data binary, running_sha1 string, last boolean, payload_bytes long, payload_digest string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _record(page_id, url: str | None, payload: memoryview, refers_to, revisit: bool) -> Iterator[bytes | memoryview]:
    """The bytes of a record, payload in slices."""
    body, digest = payload[:0] if revisit else payload, hashlib.sha1()
    for k in range(0, len(payload), CHUNK):
        digest.update(payload[k : k + CHUNK])
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else 'urn:none'}",
        f"WARC-Payload-Digest: sha1:{base32(digest.digest())}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(_HTTP) + len(body)}"]
    yield "\r\n".join(head).encode() + b"\r\n\r\n" + _HTTP
    for k in range(0, len(body), CHUNK):
        yield body[k : k + CHUNK]
    yield b"\r\n\r\n"


def _written(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, base = store(root)
        done, out, size, name, records = [], None, 0, "", 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((name, records, size))
                out = None

        for b in batches:
            for page_id, url, html, winner in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, size, records = f"part-{task:05d}-{len(done):03d}-{attempt}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = memoryview(html.as_buffer() if html.is_valid else b"").cast("B")
                z = zlib.compressobj(4, zlib.DEFLATED, 31)
                for piece in _record(page_id, url, payload, winner, winner is not None and winner != page_id):
                    size += out.write(got) if (got := z.compress(piece)) else 0
                size += out.write(z.flush())
                records += 1
                if size >= ROLL:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{root}/{d[0]}" for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["archive", "records", "bytes"])

    return run


def write(pages: DataFrame, root: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Writes the archives under root. Result: archive, records, bytes.

    least: payloads under so many bytes are never revisits. Payloads are compared by SHA-1 and length.
    """
    spark = pages.sparkSession
    short_batches(spark)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html"), F.sha1(body.cast("binary")).alias("_sha"), F.octet_length(body).cast("long").alias("_n"))
    # Only payloads that occur more than once; written, so that the join below deals rows a hot payload can be split from.
    known = rows.where(F.col("_n") >= least).groupBy(F.col("_sha").alias("_s"), F.col("_n").alias("_m")).agg(F.max("_id").alias("_winner"), F.count("*").alias("_k")).where("_k > 1 and _winner is not null")
    known = materialize(known.select("_s", "_m", "_winner"), "payloads")
    named = rows.join(known, (F.col("_sha") == F.col("_s")) & (F.col("_n") == F.col("_m")), "left").select("_id", "_url", "_html", "_winner")
    return materialize(named.mapInArrow(_written(root or scratch(spark, "warc")), "archive string, records long, bytes long"), "archives")


class _Stream:
    """Bytes of a gzip file of many members, in bounded reads."""

    def __init__(self, source):
        self.source, self.z, self.raw, self.held = source, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Adds at most READ bytes; False at the end."""
        while True:
            if not self.raw:
                self.raw = self.source.read(READ)
                if not self.raw:
                    return False
            got = self.z.decompress(self.raw, READ)
            self.raw = self.z.unconsumed_tail
            if self.z.eof:
                self.raw = self.z.unused_data
                self.z = zlib.decompressobj(31)
            if got:
                self.held += got
                return True

    def upto(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                return None
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("an archive ends within a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def records(source, archive: str) -> Iterator[tuple]:
    """Chunk rows of an open archive, in order."""
    stream = _Stream(source)
    while (head := stream.upto(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        urn = lambda name: fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None  # noqa: B023, E731
        page, kind, refers = urn("WARC-Record-ID"), fields["WARC-Type"], urn("WARC-Refers-To")
        told, total = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Bytes"])
        left = int(fields["Content-Length"])
        http = stream.upto(b"\r\n\r\n") or b""
        left -= len(http) + 4
        running, start, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.take(min(left, CHUNK))
            running.update(data)
            left -= len(data)
            now = base32(running.digest())
            if not left and kind == "response" and (now != told or start + len(data) != total):
                raise ValueError(f"record {page} of {archive}: digest {now}, {told} announced")
            yield archive, page, kind, refers, number, start, data, now, not left, total, told
            start += len(data)
            number += 1
            if not left:
                break
        stream.take(4)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split(" ")[0] for x in CHUNKS.split(",")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}.get(x.strip().split(" ")[1], pa.string()) for x in CHUNKS.split(",")]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    for b in batches:
        for archive in b.column(0).to_pylist():
            fs, path = store(archive)
            rows, held = [], 0
            with fs.open_input_stream(path, compression=None) as source:
                for row in records(source, archive):
                    rows.append(row)
                    held += len(row[6])
                    if held >= 16 * CHUNK or len(rows) >= 1000:
                        yield batch(rows)
                        rows, held = [], 0
            if rows:
                yield batch(rows)


def read(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """The chunked record table of the archives named in column archive."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(parts, "archive").mapInArrow(_read, CHUNKS)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes all pages, reads the archives back, and gives a row per record from its last chunk."""
    chunks = read(pages.sparkSession, write(pages, key=key, url=url, html=html))
    last = chunks.where("last")
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("long")
    whole = F.when(F.col("record_type") == "response", F.col("start") + F.octet_length("data")).otherwise(F.col("payload_bytes"))
    digest = F.when(F.col("record_type") == "response", F.col("running_sha1")).otherwise(F.col("payload_digest"))
    return last.select(number("record_id").alias("page_id"), whole.cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"), (F.col("chunk") + 1).alias("n_chunks"))
