"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent frames, each holding whole WARC records, and a last skippable frame with the sizes of
all frames (the seek table of the seekable format). The index maps each record identifier to its bundle, its frame and
its place within the decompressed frame, so one record costs one frame to read. Bundles are also plain ``.warc.zst``.

Bundle names are unique to a task attempt, and only attempts that Spark commits reach the index: a lost executor or
a second attempt leaves at most a file that nothing refers to. Paths go through ``pyarrow.fs``, so any store it knows
will do. Null payloads are empty; null identifiers stay null; rows repeated under one identifier are all written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Fixed value: the profile of a revisit whose payload equals that of an earlier record.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = "record_id string, bundle string, frame int, frame_start long, frame_bytes long, record_start long, record_bytes long"
RECORD_FIELDS = [
    ("record_id", pa.string(), "string"), ("record_type", pa.string(), "string"), ("refers_to", pa.string(), "string"), ("uri", pa.string(), "string"),
    ("payload_bytes", pa.int64(), "long"), ("payload_digest", pa.string(), "string"), ("intact", pa.bool_(), "boolean"), ("payload", pa.binary(), "binary"),
]


def plan_revisits(pages: DataFrame, key: str, payload: str, *, min_bytes: int = 1000, salts: int = 16) -> DataFrame:
    """Adds payload_bytes, payload_digest, record_type and refers_to to every row.

    Of rows with equal payloads of ``min_bytes`` or more, that with the largest ``key`` is the response and the others
    revisit it. Digests alone are grouped (summed before the shuffle); payloads meet the groups in a join whose hot
    digests are dealt over ``salts`` tasks, or in a broadcast where Spark finds the groups small.
    """
    named = pages.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": F.sha1(payload)})
    large = named.where(F.col("payload_bytes") >= min_bytes)
    groups = large.groupBy("payload_digest").agg(F.max(key).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    groups = common.stash(groups.select(F.col("payload_digest").alias("__digest"), "__first"), "warc-groups")
    groups = groups.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    salted = named.withColumn("__at", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    joined = salted.join(groups, (F.col("payload_digest") == F.col("__digest")) & (F.col("__at") == F.col("__salt")) & (F.col("payload_bytes") >= min_bytes), "left")
    other = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col(key))
    return joined.withColumns({"record_type": F.when(other, "revisit").otherwise("response"), "refers_to": F.when(other, F.col("__first"))}).drop("__digest", "__first", "__salt", "__at")


def _line(name: str, value: str) -> str:
    clean = "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)
    return f"{name}: {clean}\r\n"


def build_record(record_id: str | None, kind: str, refers_to: str | None, uri: str | None, payload: bytes, size: int, digest: str, date: str) -> bytes:
    """One record; a revisit has the headers of its page's response, length included, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = "WARC/1.1\r\n" + _line("WARC-Type", kind)
    if record_id is not None:
        head += _line("WARC-Record-ID", f"<urn:record:{record_id}>")
    if uri is not None:
        head += _line("WARC-Target-URI", uri)
    head += _line("WARC-Date", date) + _line("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == "revisit":
        head += _line("WARC-Profile", REVISIT_PROFILE) + _line("WARC-Refers-To", f"<urn:record:{refers_to}>")
    head += _line("Content-Type", "application/http;msgtype=response") + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: memoryview | bytes, start: int = 0) -> tuple[dict, int]:
    """The record at ``start`` of a decompressed frame and where the next one begins."""
    data = bytes(data) if not isinstance(data, bytes) else data
    split = data.index(b"\r\n\r\n", start)
    fields = dict(line.split(": ", 1) for line in data[start:split].decode().split("\r\n")[1:])
    block_at, size = split + 4, int(fields["Content-Length"])
    body_at = data.index(b"\r\n\r\n", block_at) + 4
    http = dict(line.split(": ", 1) for line in data[block_at : body_at - 4].decode().split("\r\n")[1:])
    bare = lambda name: fields[name].removeprefix("<urn:record:").removesuffix(">") if name in fields else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    record = {"record_id": bare("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": bare("WARC-Refers-To"), "uri": fields.get("WARC-Target-URI"), "payload_bytes": int(http["Content-Length"]), "payload_digest": digest, "payload": None, "intact": None}
    if record["record_type"] != "revisit":
        record["payload"] = data[body_at : block_at + size]
        record["intact"] = hashlib.sha1(record["payload"]).hexdigest() == digest and len(record["payload"]) == record["payload_bytes"]
    return record, block_at + size + 4


class BundleWriter:
    """Writes records to one bundle, frame by frame; memory is one frame."""

    def __init__(self, stream, name: str, frame_bytes: int, level: int):
        self.stream, self.name, self.frame_bytes = stream, name, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.at, self.open, self.held = 0, [], 0
        self.index: list[tuple] = []

    def add(self, record_id: str | None, record: bytes) -> None:
        if self.open and self.held + len(record) > self.frame_bytes:
            self.close_frame()
        self.open.append((record_id, record))
        self.held += len(record)

    def close_frame(self) -> None:
        if not self.open:
            return
        packed, place = self.compressor.compress(b"".join(r for _, r in self.open)), 0
        for record_id, record in self.open:
            self.index.append((record_id, self.name, len(self.frames), self.at, len(packed), place, len(record)))
            place += len(record)
        self.stream.write(packed)
        self.frames.append((len(packed), self.held))
        self.at, self.open, self.held = self.at + len(packed), [], 0

    def close(self) -> None:
        self.close_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(file, size: int) -> list[tuple[int, int]]:
    """(start, compressed bytes) of each frame, from a bundle's last bytes."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    file.seek(size - 9 - 8 * count)
    sizes, out, at = struct.unpack(f"<{2 * count}I", file.read(8 * count)), [], 0
    for i in range(count):
        out.append((at, sizes[2 * i]))
        at += sizes[2 * i]
    return out


def write_bundles(records: DataFrame, folder: str, *, bundle_bytes: int = 64 << 20, frame_bytes: int = 256 << 10, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes ``records(record_id, record_type, refers_to, uri, payload, payload_bytes, payload_digest)`` to bundles.

    Each task writes its own bundles of about ``bundle_bytes`` compressed. Returns the index, itself written below
    ``folder``; an empty input gives an empty index and no bundle.
    """
    common.ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import warc
        common.held_by("warc")

        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        writer = None

        def flush() -> pa.RecordBatch:
            writer.close()
            columns = list(zip(*writer.index, strict=True))
            kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["record_id", "bundle", "frame", "frame_start", "frame_bytes", "record_start", "record_bytes"])

        for batch in batches:
            for i in range(batch.num_rows):
                record_id, kind, refers, uri, payload, size, digest = (batch.column(k)[i].as_py() for k in range(7))
                if writer is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    writer = warc.BundleWriter(store.open_output_stream(f"{base}/{name}", compression=None), name, frame_bytes, level)
                writer.add(record_id, warc.build_record(record_id, kind, refers, uri, payload or b"", size, digest, date))
                if writer.at >= bundle_bytes:
                    yield flush()
                    writer = None
        if writer is not None:
            yield flush()

    chosen = records.select(*[F.col(c).cast(t) for c, t in (("record_id", "string"), ("record_type", "string"), ("refers_to", "string"), ("uri", "string"), ("payload", "binary"), ("payload_bytes", "long"), ("payload_digest", "string"))])
    chosen.mapInArrow(run, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return records.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _records_schema(fields: tuple[str, ...]) -> T.StructType:
    return T._parse_datatype_string(", ".join(f"{n} {s}" for n, _, s in RECORD_FIELDS if n in fields))


def read_bundles(spark: SparkSession, folder: str, index: DataFrame, *, fields: tuple[str, ...] = tuple(n for n, _, _ in RECORD_FIELDS)) -> DataFrame:
    """All records of the bundles in ``index``, read frame by frame; ``intact`` tells whether a payload fits its digest."""
    common.ship_package(spark)
    chosen = [f for f in RECORD_FIELDS if f[0] in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import warc
        common.held_by("warc")

        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{base}/{name}") as file:
                    for start, size in warc.seek_table(file, file.size()):
                        file.seek(start)
                        data, at, found = unpack.decompress(file.read(size)), 0, []
                        while at < len(data):
                            record, at = warc.parse_record(data, at)
                            found.append(record)
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k, _ in chosen], names=[n for n, _, _ in chosen])

    bundles = index.select("bundle").distinct()
    # a task for each few bundles: their names alone would look small enough for one
    dealt = bundles.repartition(max(1, min(bundles.count(), 100_000)), "bundle")
    return dealt.mapInArrow(run, _records_schema(tuple(n for n, _, _ in chosen)))


def fetch(folder: str, wanted: DataFrame, *, fields: tuple[str, ...] = tuple(n for n, _, _ in RECORD_FIELDS)) -> DataFrame:
    """The records of index rows ``wanted``, each by one seek and one frame."""
    common.ship_package(wanted.sparkSession)
    chosen = [f for f in RECORD_FIELDS if f[0] in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import warc
        common.held_by("warc")

        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            for name, start, size, place in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                with store.open_input_file(f"{base}/{name}") as file:
                    file.seek(start)
                    found.append(warc.parse_record(unpack.decompress(file.read(size)), place)[0])
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k, _ in chosen], names=[n for n, _, _ in chosen])

    return wanted.select("bundle", "frame_start", "frame_bytes", "record_start").mapInArrow(run, _records_schema(tuple(n for n, _, _ in chosen)))
