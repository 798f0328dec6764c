"""WARC archives as a table of record chunks.

Payloads travel as rows (record, chunk number, bytes), so neither the writer nor the reader ever holds a whole record: the
writer compresses chunk after chunk into the record's gzip member, the reader yields chunk after chunk with the number and the
SHA-1 of the payload bytes so far. Archives are rotated at a bounded size, named by task attempt, and listed in a manifest that
holds those of successful attempts only; they lie in the shared folder, through pyarrow's file systems (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialised, scratch

#: Bytes of a chunk, compressed bytes after which an archive is closed, and records in flight to a Python worker.
CHUNK, ARCHIVE = 1 << 18, 64 << 20
SCHEME = "urn:quire:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _number(text: str | None) -> int | None:
    return int(text) if text and text != "null" else None


def record_head(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, kind: str, date: str) -> bytes:
    """WARC and HTTP headers up to the payload. A revisit keeps the payload's length in its HTTP header and has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = " ".join((url or "").split()) or "about:blank"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{SCHEME}{'null' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (size if kind == 'response' else 0)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{SCHEME}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + http


class Inflated:
    """Reads gzip members one after the other; memory is bounded by the block size, whatever the members' sizes."""

    def __init__(self, raw: BinaryIO, block: int = 1 << 16):
        self.raw, self.block, self.rest, self.out, self.z = raw, block, b"", b"", None

    def _more(self) -> bool:
        while True:
            if not self.rest:
                self.rest = self.raw.read(self.block)
                if not self.rest:
                    return False
            if self.z is None or self.z.eof:
                self.z = zlib.decompressobj(31)
            got = self.z.decompress(self.rest, self.block)
            self.rest = self.z.unconsumed_tail or self.z.unused_data
            if got:
                self.out += got
                return True

    def line(self) -> bytes:
        """Up to and with the next line feed; empty at the end."""
        while (k := self.out.find(b"\n")) < 0:
            if not self._more():
                k = len(self.out) - 1
                break
        got, self.out = self.out[: k + 1], self.out[k + 1 :]
        return got

    def take(self, most: int) -> bytes:
        """Between 1 and most bytes; none at the end."""
        if not self.out and not self._more():
            return b""
        got, self.out = self.out[:most], self.out[most:]
        return got


def _headers(stream: Inflated) -> tuple[dict[str, str], int]:
    """Header fields up to the empty line, and their size."""
    fields, size = {}, 0
    while (line := stream.line()).strip():
        size += len(line)
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, size + len(line)


def read_records(raw: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple]:
    """(page_id, kind, refers_to, header digest, chunk_no, data, bytes_so_far, sha1_so_far, last) for each chunk of each record.

    bytes_so_far and sha1_so_far are of the payload; a revisit has one empty chunk, which carries those of the payload it
    stands for, from its headers. An empty payload has one empty chunk. A payload that differs from the SHA-1 in its header
    raises a ValueError at its last chunk.
    """
    stream = Inflated(raw)
    while True:
        version = stream.line()
        if not version:
            return
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        head, _ = _headers(stream)
        status = stream.line()
        http, size = _headers(stream)
        lacking = {"content-length", "warc-record-id", "warc-type", "warc-payload-digest"} - head.keys()
        if lacking or "content-length" not in http:
            raise ValueError(f"a record's header ends early or lacks {sorted(lacking) or 'the length of its payload'}")
        left = int(head["content-length"]) - size - len(status)
        page = _number(head["warc-record-id"].strip("<>").removeprefix(SCHEME))
        named, kind = head["warc-payload-digest"], head["warc-type"]
        digest = named.removeprefix("sha1:")
        refers = _number(head["warc-refers-to"].strip("<>").removeprefix(SCHEME)) if "warc-refers-to" in head else None
        if kind == "revisit":
            yield page, kind, refers, digest, 0, b"", int(http["content-length"]), base64.b32decode(digest), True
            continue
        sha, done, number = hashlib.sha1(), 0, 0
        while True:
            part = bytearray()
            while left and len(part) < chunk:
                got = stream.take(min(left, chunk - len(part)))
                if not got:
                    raise ValueError(f"record {page} ends early")
                part += got
                left -= len(got)
            sha.update(part)
            done += len(part)
            if not left and named.startswith("sha1:") and base32(sha.digest()) != digest:
                raise ValueError(f"the payload of record {page} isn't that of its digest")
            yield page, kind, refers, digest, number, bytes(part), done, sha.copy().digest(), not left
            number += 1
            if not left:
                break


def chunks_of(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, kind, refers_to, digest, size, chunk_no, data): pages (page_id, url, html) as ordered chunk rows.

    Of rows with equal payloads (null html counts as empty) those with the smallest page_id are responses, the others revisits of
    it. Null ids are never the smallest; where all are null, all rows are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    rows = rows.join(firsts, "digest", "left").withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    size = F.octet_length("payload").cast("long")
    pieces = F.when(F.col("revisit"), 1).otherwise(F.greatest(F.lit(1), F.ceil(size / chunk).cast("int")))
    return rows.select(
        "page_id", "url", F.when(F.col("revisit"), "revisit").otherwise("response").alias("kind"), F.when(F.col("revisit"), F.col("first")).alias("refers_to"),
        "digest", size.alias("size"), "payload", "revisit", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("chunk_no"),
    ).select("page_id", "url", "kind", "refers_to", "digest", "size", "chunk_no", F.when(~F.col("revisit"), F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).alias("data"))


def written(chunks: DataFrame, folder: str, archive: int = ARCHIVE, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the records of chunks_of() to archives in folder; returns the manifest (path, records, bytes), which is a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name, number, out, records, size, z = f"{base}/part-{TaskContext.get().taskAttemptId()}", 0, None, 0, 0, None
        done = []

        def close() -> None:
            nonlocal out, records, size, number
            if out:
                out.close()
                done.append((f"{name}-{number}.warc.gz", records, size))
            out, records, size, number = None, 0, 0, number + 1

        def put(data: bytes) -> None:
            nonlocal size
            size += len(data)
            out.write(data)

        def end_record() -> None:
            nonlocal z
            if z:
                put(z.compress(b"\r\n\r\n") + z.flush())
            z = None

        for b in batches:
            for r in b.to_pylist():
                if r["chunk_no"] == 0:
                    end_record()
                    if size >= archive:
                        close()
                    out = out or system.open_output_stream(f"{name}-{number}.warc.gz")
                    records, z = records + 1, zlib.compressobj(3, zlib.DEFLATED, 31)
                    put(z.compress(record_head(r["page_id"], r["url"], base32(r["digest"]), r["size"], r["refers_to"], r["kind"], date)))
                if r["data"]:
                    put(z.compress(r["data"]))
        end_record()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return materialised(chunks.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_chunks(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk rows of the archives in manifest; see read_records. Without data the bytes are read and digested, but not returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        names = ["page_id", "kind", "refers_to", "digest", "chunk_no", "data", "bytes_so_far", "sha1_so_far", "last"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.bool_()]
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for path in b.column(0).to_pylist():
                with system.open_input_stream(path) as raw:
                    for r in read_records(raw, chunk):
                        rows.append(r if with_data else (*r[:5], None, *r[6:]))
                        held += len(r[5]) * with_data + 200
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "page_id long, kind string, refers_to long, digest string, chunk_no int, data binary, bytes_so_far long, sha1_so_far binary, last boolean"
    archives = min(10_000, max(1, manifest.count()))
    return manifest.select("path").repartition(archives).mapInArrow(run, schema)


def archived(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Writes pages to archives and reads them back: a row (page_id, kind, refers_to, payload_bytes, sha1, digest) for each page.

    sha1 is of the bytes read, digest the one in the header; a response in which they differ stops the job.

    Empty tables give no archive and no row; repeated rows give a record each; other columns are not looked at.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    manifest = written(chunks_of(pages, chunk), folder)
    ends = read_chunks(manifest, folder, chunk, with_data=False).where("last")
    return ends.select("page_id", "kind", "refers_to", F.col("bytes_so_far").alias("payload_bytes"), F.col("sha1_so_far").alias("sha1"), "digest")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """The digest is that of the bytes read; for revisits, which have none, that in their header."""
    rows = archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = F.concat(*(F.lpad(F.conv(F.substring(F.hex("sha1"), 5 * k + 1, 5), 16, 2), 20, "0") for k in range(8)))
    code = F.concat(*(F.substring(F.lit(alphabet), F.conv(F.substring(bits, 5 * k + 1, 5), 2, 10).cast("int") + 1, F.lit(1)) for k in range(32)))
    return rows.select("page_id", "payload_bytes", code.alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
