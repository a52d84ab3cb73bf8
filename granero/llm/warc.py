"""Writing pages to WARC archives and reading archives in byte ranges.

Every record is a gzip member of its own. A reader task gets a byte range of an
archive, looks for the gzip magic number, takes a place for a member's start only
if decoding it yields a WARC header, and owns the records that start inside its
range; the last one is read beyond the range's end. After a valid member the
next one is expected right behind it, so the search is for the first record only
(or goes on after damaged bytes).

Archives go through ``pyarrow.fs``, so a folder may be a path every machine
sees or a URI of a store pyarrow knows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granero.session import scratch_path, stage

MAGIC = b"\x1f\x8b\x08"
RANGE = 16 << 20
MOST_TASKS = 20_000
CHUNK = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark would open it by, so that tasks write where Spark reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(conf).makeQualified(hadoop_path).toString()


def store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[5:]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{copy}')}>"


def record(page_id, url, digest: str, size: int, payload: bytes | None, first, copy: int, date: str = DATE) -> bytes:
    """One compressed record: a response with its payload, or (``payload`` None) a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(first, digest, 1)}"]
        if first is not None:
            lines.append(f"X-Refers-To-Page-ID: {first}")
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def records_of(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, digest (hex), size, html, first, copy: what to write; html is null for revisits.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    smallest page_id (null last; then the smallest url) is written, the others
    refer to it. Null html is an empty payload. Payloads meet by digest only,
    combined before the shuffle, so copies move once per task.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
        payload.alias("html"),
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    small = rows.where(F.col("size") < least).select("page_id", "url", "digest", "size", "html", F.lit(None).cast("long").alias("first"), F.lit(1).alias("copy"))
    large = rows.where(F.col("size") >= least)
    responses = large.groupBy("digest", "size").agg(F.min(order).alias("m"), F.first("html").alias("html")).select(
        F.col("m.page_id").alias("page_id"), F.col("m.url").alias("url"), "digest", "size", "html",
        F.lit(None).cast("long").alias("first"), F.lit(1).alias("copy"),
    )
    firsts = large.groupBy("digest").agg(F.min(order).alias("m")).select(F.col("digest").alias("_digest"), F.col("m.page_id").alias("first"))
    nth = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url"))
    revisits = (
        large.select("page_id", "url", "digest", "size")
        .withColumn("copy", nth)
        .join(firsts, F.col("digest") == F.col("_digest"))
        .where(~F.col("page_id").eqNullSafe(F.col("first")) | (F.col("copy") > 1))
        .select("page_id", "url", "digest", "size", F.lit(None).cast("string").alias("html"), "first", "copy")
    )
    return responses.unionByName(small).unionByName(revisits)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, date: str = DATE) -> DataFrame:
    """path, bytes, n_records of the archives written below ``folder`` (default: a scratch folder), one per task.

    ``pages`` has page_id, url and html. The archives of a task carry its attempt
    in their name and only those of finished tasks are listed, so a lost
    executor leaves files that nobody reads. A folder without a scheme is one of
    Spark's default file system; of the schemes that Spark knows pyarrow opens
    file, hdfs, viewfs, s3, gs and abfs.
    """
    folder = qualified(pages.sparkSession, folder or scratch_path(pages.sparkSession, "warc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, root = store(folder)
        path = f"{root}/part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        out, size, count = None, 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, digest, n, html, first, copy = (column[row] for column in batch.columns)
                body = html.as_buffer().to_pybytes() if html.is_valid else None
                name = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                data = record(page_id.as_py(), url.as_py(), name, n.as_py(), body, first.as_py(), copy.as_py(), date)
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(path, compression=None)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            name = folder.rstrip("/") + "/" + path.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([count])], names=["path", "bytes", "n_records"])

    written = records_of(pages, least).mapInArrow(run, "path string, bytes long, n_records long")
    return stage(written, "archives")


class _Source:
    """Bytes of a file from any place on, fetched in chunks; only a few chunks are held."""

    def __init__(self, file):
        self.file, self.at, self.held = file, 0, b""

    def chunk(self, place: int, least: int = 1) -> bytes:
        """Some bytes from ``place`` on, ``least`` of them unless the file ends before; empty at its end."""
        if not self.at <= place <= self.at + len(self.held) - least:
            self.file.seek(place)
            self.at, self.held = place, self.file.read(CHUNK)
        return self.held[place - self.at :]


def _member(source: _Source, start: int) -> tuple[bytes, int] | None:
    """The decoded record that starts at ``start`` and the place behind it; None if no record starts there."""
    unpack, parts, got, place = zlib.decompressobj(31), [], 0, start
    checked = False
    try:
        while not unpack.eof:
            data = source.chunk(place)
            if not data:
                return None
            if not checked:  # decode a little first: most wrong places fail here
                data = data[:512]
            parts.append(unpack.decompress(data))
            place += len(data) - len(unpack.unused_data)
            got += len(parts[-1])
            if not checked and (got >= 7 or unpack.eof):
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    raw = b"".join(parts)
    return (raw, place) if checked and b"\r\n\r\n" in raw else None


def records_in(file, size: int, low: int, high: int) -> Iterator[bytes]:
    """Decoded records that start in bytes [low, high) of an archive of ``size`` bytes."""
    source, place = _Source(file), low
    while place < min(high, size):
        data = source.chunk(place, len(MAGIC))
        if not data:
            return
        if data.startswith(MAGIC):
            found = _member(source, place)
            if found:
                yield found[0]
                place = found[1]
                continue
            place += 1
            continue
        at = data.find(MAGIC)
        # A magic number may lie across two chunks: the last two bytes are fetched again with the next ones.
        place += at if at >= 0 else max(1, len(data) - 2)


def parsed(raw: bytes) -> dict:
    """Fields of a decoded record; the payload's digest is checked where the payload is there."""
    header, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base32_sha1(payload) != digest:
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    declared = re.search(rb"Content-Length: (\d+)", http)
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": len(payload) if kind == "response" else int(declared[1]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_archives(archives: DataFrame, payloads: bool = True, size: int = RANGE) -> DataFrame:
    """One row per record of the archives (path, bytes): page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Ranges of ``size`` bytes are dealt evenly, each to a task of its own up to
    ``MOST_TASKS`` of them: a row that names a range is small, so Spark would
    merge them by their bytes. Without archives, no rows.
    A damaged stretch is passed over up to the next valid member; a payload
    that does not match its digest is an error. ``payloads`` False leaves them out.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(size).cast("long"))
    ranges = archives.select("path", "bytes", F.explode(starts).alias("low"))
    n_ranges = archives.agg(F.sum(F.greatest(F.ceil(F.col("bytes") / size), F.lit(1)))).first()[0] or 1
    ranges = ranges.repartition(min(int(n_ranges), MOST_TASKS))
    schema = _SCHEMA if payloads else _SCHEMA.remove(_SCHEMA.get_field_index("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = store(row["path"])
                held, held_bytes = [], 0
                with files.open_input_file(path) as file:
                    for raw in records_in(file, row["bytes"], row["low"], row["low"] + size):
                        held.append(parsed(raw))
                        held_bytes += len(raw) if payloads else 200
                        if held_bytes > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, held_bytes = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    spark_schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return ranges.mapInArrow(run, spark_schema + ", payload binary" * payloads)
