"""WARC archives as seekable Zstandard bundles.

Each task writes one bundle: WARC 1.1 records gathered into Zstandard frames that can be read independently, and
after them a skippable frame with the seek table of the public seekable format (compressed and decompressed
size of each frame). An index table maps each record identifier to its bundle, its frame and its offset in the
decompressed frame, so one record costs one frame.

Of records with equal payloads the one with the largest identifier is the `response`; the others are `revisit`
records that name it and hold the HTTP header, with the payload's length, without the payload. Payloads below
`least` bytes are all stored.

The bundles of finished tasks are named in the index; what a lost task has left has another name and is not read.

Defined results: a null payload is empty; an empty payload is a payload like others; rows with equal identifier
and equal payload are one `response` each, since none of them is a copy of another record; a null identifier
counts as smaller than all others, gets the record name `none` and is null in the index; other columns are not
read; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import file_system, map_arrow, open_file, written

#: Decompressed bytes of a frame before it is closed; a longer record has a frame of its own.
FRAME_BYTES = 1 << 20
LEVEL = 3
#: Most tasks that read an archive back.
READERS = 4096
# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"


def record_name(key) -> str:
    return f"urn:record:{'none' if key is None else key}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, key, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One WARC record: an HTTP header, and the payload if it is a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_name(key)}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {''.join((url or '').splitlines())}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        head += [
            f"WARC-Refers-To: <{record_name(refers_to)}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], memoryview, int]:
    """(headers in lower case, block, offset after the record)."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(headers["content-length"])
    return headers, memoryview(data)[end + 4 : end + 4 + size], end + 8 + size


class BundleWriter:
    """Records into frames; close() appends the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self.out, self.most, self.frames, self.parts, self.size = out, frame_bytes, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        if self.parts and self.size + len(record) > self.most:
            self._end_frame()
        place = len(self.frames), self.size
        self.parts.append(record)
        self.size += len(record)
        return place

    def _end_frame(self) -> None:
        packed = self.compressor.compress(b"".join(self.parts))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.parts, self.size = [], 0

    def close(self) -> None:
        if self.parts:
            self._end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to the frames of an open bundle."""

    def __init__(self, file):
        self.file = file  # of pyarrow
        size = file.size()
        file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", file.read(8 * n)):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[k]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed))


@dataclass(frozen=True)
class Archive:
    folder: str
    index: DataFrame  # key, bundle, frame, offset


def with_decisions(pages: DataFrame, key: str, url: str, html: str, least: int) -> DataFrame:
    """key, url, html, refers_to. Only digests are grouped; the join is on the digest and splits where one is frequent."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "utf-8"))).withColumn("bytes", F.octet_length("html"))
    largest = rows.groupBy("digest").agg(F.max("key").alias("top"), F.count(F.lit(1)).alias("copies"))
    largest = largest.filter("copies > 1").drop("copies")
    found = rows.join(largest, "digest", "left")
    copy = (F.col("bytes") >= least) & ~F.col("top").eqNullSafe(F.col("key")) & F.col("top").isNotNull()
    return found.select("key", "url", "html", copy.alias("copy"), F.when(copy, F.col("top")).alias("refers_to"))


def write_archive(
    pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, frame_bytes: int = FRAME_BYTES,
) -> Archive:
    """Writes a record per row into bundles below `folder`; the index is a Parquet table in the shared folder."""
    kind = pages.schema[key].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bundle, name = None, f"bundle-{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.warc.zst"
        try:
            for batch in batches:
                places = []
                for k, u, h, copy, top in zip(*(c.to_pylist() for c in batch.columns)):
                    if bundle is None:
                        fs, at = file_system(f"{folder}/{name}")
                        fs.create_dir(at.rpartition("/")[0], recursive=True)
                        bundle = BundleWriter(fs.open_output_stream(at, compression=None), frame_bytes)
                    payload = h.encode()
                    places.append(bundle.add(record_bytes("revisit" if copy else "response", k, u, payload, payload_digest(payload), top)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([name] * len(places), pa.string()),
                     pa.array([f for f, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())],
                    ["key", "bundle", "frame", "offset"],
                )
        finally:
            if bundle is not None:
                bundle.close()

    index = map_arrow(with_decisions(pages, key, url, html, least), write, f"key {kind}, bundle string, frame long, offset long")
    return Archive(folder, written(index, "warc-index"))


def read_archive(archive: Archive, readers: int = READERS) -> DataFrame:
    """Every record read back through the index: key, payload_bytes, payload_digest, record_type, refers_to, and its place.
    The index says in which frame of which bundle and where in the frame a record begins, the seek table where the frame
    is. A record that is not there, has another identifier or does not end where the next one begins is an error, and so
    is a frame or an end of a bundle that the index does not know. A response's digest is computed from the payload read.

    Bundles are dealt over as many tasks as there are bundles, `readers` at most; a task holds one frame at a time."""
    folder = archive.folder
    kind = archive.index.schema["key"].dataType
    id_type = pa.int64() if kind.typeName() == "long" else pa.int32() if kind.typeName() == "integer" else pa.string()

    def number(name: str):
        name = name.strip("<>").removeprefix("urn:record:")
        return None if name == "none" else int(name) if id_type != pa.string() else name

    def checked(bundle: BundleReader, name: str, frame: int, places: list[tuple]) -> Iterator[tuple]:
        """The records of a frame, whose keys and offsets in the index are `places`."""
        data, at = bundle.frame(frame), 0
        for key, offset in places:
            if offset != at:
                raise ValueError(f"the index of {name} has a record at {offset} of frame {frame}, which begins at {at}")
            head, block, at = parse_record(data, offset)
            if str(number(head["warc-record-id"])) != str(key):
                raise ValueError(f"{name} holds {head['warc-record-id']} where the index has {key}")
            http, _, payload = bytes(block).partition(b"\r\n\r\n")
            length = int(http.rpartition(b"Content-Length: ")[2])
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            if head["warc-type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
                raise ValueError(f"damaged record in {name}")
            to = head.get("warc-refers-to")
            yield key, length, digest, head["warc-type"], to and number(to), frame, offset, name
        if at != len(data):
            raise ValueError(f"{name} holds more records in frame {frame} than its index")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = ((r["bundle"], r["frame"], r["key"], r["offset"]) for batch in batches for r in batch.to_pylist())
        for name, frames in groupby(places, key=lambda p: p[0]):
            with open_file(f"{folder}/{name}") as file:
                bundle, seen = BundleReader(file), 0
                for frame, rows in groupby(frames, key=lambda p: p[1]):
                    if frame != seen or frame >= len(bundle.frames):
                        raise ValueError(f"the index of {name} has frame {frame} after {seen} of {len(bundle.frames)}")
                    seen += 1
                    columns = zip(*checked(bundle, name, frame, [p[2:] for p in rows]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                if seen != len(bundle.frames):
                    raise ValueError(f"{name} has {len(bundle.frames)} frames, its index {seen}")

    types = [id_type, pa.int64(), pa.string(), pa.string(), id_type, pa.int64(), pa.int64(), pa.string()]
    names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to", "frame", "offset", "bundle"]
    k = kind.simpleString()
    bundles = max(1, min(readers, archive.index.select("bundle").distinct().count()))
    dealt = archive.index.repartitionByRange(bundles, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    return map_arrow(
        dealt.select("bundle", "frame", "key", "offset"), read,
        f"key {k}, payload_bytes long, payload_digest string, record_type string, refers_to {k}, frame long, offset long, bundle string",
    )


def read_records(archive: Archive, wanted: DataFrame, key: str) -> DataFrame:
    """The wanted records by their identifiers, through index and seek table: key, headers, block. Each frame that
    holds one is decompressed once."""
    folder = archive.folder
    kind = archive.index.schema["key"].dataType.simpleString()
    places = archive.index.join(wanted.select(F.col(key).alias("key")).distinct(), "key")

    def fetch(group):
        import pandas as pd

        rows = []
        with open_file(f"{folder}/{group['bundle'].iloc[0]}") as file:
            bundle = BundleReader(file)
            for k, part in group.groupby("frame"):
                data = bundle.frame(int(k))
                for identifier, at in zip(part["key"], part["offset"]):
                    head, block, _ = parse_record(data, int(at))
                    rows.append((identifier, head, bytes(block)))
        return pd.DataFrame(rows, columns=["key", "headers", "block"])

    return places.groupBy("bundle").applyInPandas(fetch, f"key {kind}, headers map<string,string>, block binary")
