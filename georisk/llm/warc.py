"""WARC archives with an embedded Zstandard dictionary.

An archive starts with a skippable frame that holds a dictionary built from
the archive's own records; every record follows as a frame of its own,
compressed with that dictionary, so single records can be read by offset.

Archives are written by the tasks to a folder that all executors share and
that pyarrow.fs can open (file, hdfs, s3, gs).  An attempt writes under a name
of its own and renames the finished file; only the files of successful
attempts enter the manifest, a table written by Spark, so a lost executor
leaves at most files that no manifest names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, scratch_path

DICTIONARY_FRAME = 0x184D2A5D
RECORD_ID = "urn:x-page:"


@dataclass(frozen=True)
class Params:
    """Payload bytes an archive is closed at, dictionary size, compression level, records' date.

    Payloads of at least ``min_revisit`` bytes that equal an earlier page's become revisits.
    """

    archive_bytes: int = 16 << 20
    dictionary_bytes: int = 64 << 10
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"
    min_revisit: int = 0


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
           date: str) -> bytes:
    """One WARC/1.1 record.  A revisit has the HTTP header alone; both state the full payload's length and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{RECORD_ID}{page_id}:{digest}>", f"WARC-Date: {date}"]
    if url is not None:
        # white space and controls can't stand in a header line
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{RECORD_ID}{refers_to}:{digest}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names lower-cased) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} has another length than it states")
    return fields, rest[:size]


def dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary from all of an archive's records; too few to train on: their end as raw content."""
    try:
        return zstandard.train_dictionary(size, records, k=512, d=8, f=20, accel=2).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def write_archive(records: list[bytes], p: Params) -> bytes:
    held = dictionary(records, p.dictionary_bytes)
    own = zstandard.ZstdCompressor(level=p.level, dict_data=zstandard.ZstdCompressionDict(held), write_checksum=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(held)), held, *map(own.compress, records)])


def read_archive(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one at a time, from a file-like object."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    data = stream.read(step)
    while data:
        frame, out = opener.decompressobj(), []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                break
            data = stream.read(step)
            if not data:
                raise ValueError("the archive ends inside a record")
        yield b"".join(out)
        data = frame.unused_data or stream.read(step)


def _with_referrals(pages: DataFrame, p: Params) -> DataFrame:
    """``page_id, url, payload, sha1, first``: ``first`` is the smallest page_id of an equal payload, if another's."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    narrow = rows.filter(F.octet_length("payload") >= p.min_revisit).select("page_id", "sha1")
    firsts = (narrow.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1 AND first IS NOT NULL").select("sha1", "first"))
    later = (narrow.join(firsts, "sha1").filter("NOT page_id <=> first").distinct()
             .select(F.col("page_id").alias("p"), F.col("sha1").alias("s"), "first"))
    return rows.join(later, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s")), "left").drop("p", "s")


def write_pages(pages: DataFrame, folder: str, p: Params = Params()) -> DataFrame:
    """Write a record per row of ``pages``; the manifest ``(path, records, payload_bytes, archive_bytes)``.

    Of equal payloads the smallest page_id is the response and the others are
    revisits.  Rows that repeat the smallest page_id are all responses; a null
    page_id comes after all others, and without any other all are responses.
    A null html is an empty payload.
    """
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        records: list[bytes] = []
        size = 0

        def close():
            name = f"{base}/{uuid.uuid4().hex}"
            data = write_archive(records, p)
            with store.open_output_stream(f"{name}.tmp", compression=None) as out:
                out.write(data)
            store.move(f"{name}.tmp", f"{name}.warc.zst")
            made = [f"{folder}/{name.rpartition('/')[2]}.warc.zst"], [len(records)], [size], [len(data)]
            return pa.RecordBatch.from_arrays([pa.array(made[0]), *(pa.array(x, pa.int64()) for x in made[1:])],
                                              names=["path", "records", "payload_bytes", "archive_bytes"])

        store.create_dir(base, recursive=True)
        for b in batches:
            for i, url, text, sha1, first in zip(*b.columns):
                payload = text.as_py().encode()
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                to = first.as_py()
                records.append(record(i.as_py(), url.as_py(), payload, digest, to, to is not None, p.date))
                size += len(payload)
                if size >= p.archive_bytes:
                    yield close()
                    records, size = [], 0
        if records:
            yield close()

    made = _with_referrals(pages, p).select("page_id", "url", "payload", "sha1", "first").mapInArrow(
        run, "path string, records long, payload_bytes long, archive_bytes long")
    return cut_lineage(made, "warc-manifest")


def read_pages(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the archives that ``manifest`` names, in any order.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` and,
    if asked for, the ``payload`` bytes (null for a revisit).  A response whose
    payload isn't what its header states raises an error.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

    def page(urn: str) -> int | None:
        number = urn.removeprefix(f"<{RECORD_ID}").partition(":")[0]
        return None if number == "None" else int(number)

    def row(data: bytes) -> tuple:
        fields, block = parse(data)
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        size, payload = int(fields["warc-payload-length"]), block.partition(b"\r\n\r\n")[2]
        if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is not what its header states")
        to = page(fields["warc-refers-to"]) if kind == "revisit" else None
        out = page(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, kind, to
        return (*out, payload if kind == "response" else None) if payloads else out

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as stream:
                    for data in read_archive(stream):
                        rows.append(row(data))
                        size += len(data) * payloads
                        if len(rows) >= 2000 or size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, 1)
    return (manifest.select("path").repartition(4 * tasks, F.xxhash64("path"))
            .mapInArrow(run, schema + ", payload binary" * payloads))


def round_trip(spark: SparkSession, pages: DataFrame, p: Params = Params(), payloads: bool = False) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the archives back."""
    return read_pages(write_pages(pages, scratch_path(spark, "warc"), p), payloads)
