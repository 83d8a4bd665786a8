"""WARC archives as seekable Zstandard bundles.

A bundle is one file. Records are grouped into frames that can be read on their own; a skippable frame at the end holds the seek
table (compressed and uncompressed size of each frame, in the public seekable format). A record is found by its frame and the offset inside
that frame; the index that maps identifiers to these is a table beside the bundles.

Equal payloads of at least ``min_payload`` bytes are stored once: the record with the smallest id is the response, the others are
revisits that refer to it. Nulls: a null payload is empty; a null url is left out of the header; a null id gives a record with an empty
id that never is a first one. Rows that repeat an id each give a record of their own; rows that share both the id and the payload of a response
are responses too. Empty tables give no bundle.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import cut_lineage, scratch_path

# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = "bundle string, frame int, offset bigint, length bigint, page_id bigint"


@dataclass(frozen=True)
class WarcConfig:
    """``frame_bytes`` of records (uncompressed) per frame, ``bundle_bytes`` (compressed) per file, both give or take one record."""

    min_payload: int = 100
    frame_bytes: int = 1 << 20
    bundle_bytes: int = 32 << 20
    level: int = 3
    #: the ``WARC-Date`` of all records: given, not taken from a clock, so that reruns write the same bytes
    date: str = "1970-01-01T00:00:00Z"


def plan_records(pages: DataFrame, config: WarcConfig = WarcConfig()) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to``: null ``refers_to`` for responses."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.filter(F.col("payload_bytes") >= config.min_payload)
    # combined in each task before the shuffle: a payload in a third of all rows is one row per task
    firsts = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(firsts, "payload_digest", "left")
    repeat = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(repeat, F.col("first_id")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = WarcConfig.date) -> bytes:
    """One WARC record. A revisit carries no payload, only its digest and length."""
    clean = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head += [f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if clean is not None:
        head.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = payload if refers_to is None else b""
    head += [f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of these (compressed, uncompressed) sizes."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int]]:
    """(start, compressed size) of each frame; ``data`` may be the end of a bundle that holds the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    entry = 12 if flags & 0x80 else 8
    table, at, out = data[len(data) - 9 - entry * n : len(data) - 9], 0, []
    for k in range(n):
        size = struct.unpack_from("<I", table, entry * k)[0]
        out.append((at, size))
        at += size
    return out


def parse_record(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and end of the record at ``offset``."""
    head_end = data.index(b"\r\n\r\n", offset)
    lines = data[offset:head_end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {offset}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = head_end + 4
    end = start + int(headers["Content-Length"])
    return headers, data[start:end], end + 4


class _Bundle:
    """Collects records into frames and writes a whole file at once; a file appears under its name only when complete."""

    def __init__(self, folder: str, name: str, config: WarcConfig):
        import zstandard

        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.path, self.name, self.config = f"{root}/{name}", name, config
        self.packer = zstandard.ZstdCompressor(level=config.level)
        self.frames: list[tuple[int, int]] = []
        self.packed: list[bytes] = []
        self.open = bytearray()

    def add(self, data: bytes) -> tuple[int, int]:
        place = (len(self.frames), len(self.open))
        self.open += data
        if len(self.open) >= self.config.frame_bytes:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.open:
            packed = self.packer.compress(bytes(self.open))
            self.frames.append((len(packed), len(self.open)))
            self.packed.append(packed)
            self.open = bytearray()

    @property
    def size(self) -> int:
        return sum(c for c, _ in self.frames)

    def close(self) -> None:
        self.end_frame()
        part = f"{self.path}.{TaskContext.get().taskAttemptId()}.part"
        with self.fs.open_output_stream(part) as out:
            for packed in self.packed:
                out.write(packed)
            out.write(seek_table(self.frames))
        self.fs.move(part, self.path)


def write_archive(records: DataFrame, folder: str, config: WarcConfig = WarcConfig()) -> DataFrame:
    """Write the bundles under ``folder`` (a URI all executors share) and return the index table.

    A file is named by stage attempt and task attempt as well, so a repeated or speculative task never touches another's
    file; the index, committed by Spark, names the files that count.
    """
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"bundle-{context.partitionId():05d}-{context.stageId()}-{context.taskAttemptId()}"
        bundle, serial, placed = None, 0, []

        def finish() -> pa.RecordBatch:
            bundle.close()
            rows = list(zip(*placed))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["bundle", "frame", "offset", "length", "page_id"],
            )

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "payload_digest", "refers_to")]
            for page_id, url, payload, digest, refers_to in zip(*columns):
                if bundle is None:
                    bundle = _Bundle(folder, f"{stem}-{serial:04d}.warc.zst", config)
                    serial += 1
                data = record(page_id, url, payload, digest, refers_to, config.date)
                frame, offset = bundle.add(data)
                placed.append((bundle.name, frame, offset, len(data), page_id))
                if bundle.size >= config.bundle_bytes:
                    yield finish()
                    bundle, placed = None, []
        if bundle is not None:
            yield finish()

    wanted = records.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return cut_lineage(wanted.mapInArrow(run, INDEX_SCHEMA), "warc-index", f"{folder}/index")


class _Reader:
    """Reads frames of one bundle by range: first the footer, then only what is asked for."""

    def __init__(self, folder: str, name: str):
        import zstandard

        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.name, self.opener, self.frame, self.data = name, zstandard.ZstdDecompressor(), -1, b""
        self.file = self.fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        count = struct.unpack("<IBI", self.file.read_at(9, size - 9))[0]
        foot = min(size, 9 + 12 * count)
        self.table = read_seek_table(self.file.read_at(foot, size - foot))

    def frame_bytes(self, frame: int) -> bytes:
        if frame != self.frame:
            start, size = self.table[frame]
            self.frame, self.data = frame, self.opener.decompress(self.file.read_at(size, start))
        return self.data


def read_archive(folder: str, index: DataFrame) -> DataFrame:
    """``page_id, record_type, refers_to, payload_bytes, payload_digest`` of every indexed record.

    Each record is read at the frame and offset the index states; only the index is dealt to the tasks, a task seeks in the
    bundles itself. The digest of a response is checked against the stored payload; a revisit states the digest and length it had.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        reader = None
        for batch in batches:
            rows = []
            for name, frame, offset in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if reader is None or reader.name != name:
                    reader = _Reader(folder, name)
                head, body, _ = parse_record(reader.frame_bytes(frame), offset)
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                length, refers = int(head["X-Payload-Length"]), head.get("WARC-Refers-To")
                if refers is None and (hashlib.sha256(body).hexdigest() != digest or len(body) != length):
                    raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                own = head["WARC-Record-ID"][len("<urn:page:") : -1]
                refers = None if refers is None else int(refers[len("<urn:page:") : -1])
                rows.append((int(own) if own else None, head["WARC-Type"], refers, length, digest))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    # the index is small, the bundles are not: the number of tasks follows from the bundles
    bundles = index.select("bundle").distinct().count()
    places = index.select("bundle", "frame", "offset").repartition(max(bundles, 1), "bundle").sortWithinPartitions("bundle", "frame", "offset")
    schema = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
    return places.mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, folder: str | None = None, config: WarcConfig = WarcConfig()) -> DataFrame:
    """Write all ``pages`` as WARC records, then read the archives back."""
    folder = folder or shared_uri(scratch_path(pages.sparkSession, "warc"))
    index = write_archive(plan_records(pages, config), folder, config)
    return read_archive(folder, index)


def shared_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"
