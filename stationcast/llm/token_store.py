"""Token ids of documents as raw files in key order, with keyed access through a minimal perfect hash.

A store has three kinds of files below one folder:

* `shards/…ids`   16 bytes of header (magic, bytes per id), then the raw ids of many documents, each closed by
  the end id. Shards follow one another in ascending key order.
* `index/…mph`    a minimal perfect hash over the keys of one hash bucket, and in its slots a 32-bit fingerprint
  of the key, the shard, the offset of the document's first id in it and the number of its ids. A key is found
  in constant time: hash it, take its bucket, probe the levels of bits, count bits for the slot, compare the
  fingerprint.
* `entries` and `manifest`  Parquet tables that name the files of finished tasks only. A task that is lost and
  runs again writes files of another name, so what a lost executor has left is never read.

Defined results: a null text is empty and holds the end id alone; rows with the same key stay one after another,
ordered by the hash of the text, and are told apart by their ordinal; a null key comes first; an empty table
gives an empty store; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm import tokens
from stationcast.llm.support import file_system, map_arrow, open_file, session, with_prefix_sums, write_file, written

MAGIC = b"TOKENIDS"
HEADER = 16
#: Keys that one bucket of the index holds on average.
BUCKET_KEYS = 50_000
GAMMA = 2.0


# ---------------------------------------------------------------- minimal perfect hash

def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    x = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (_mixed(h, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bit arrays: a key belongs to the first level on which it alone has its position; its slot is the
    number of set bits before that position."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ranks, total = [], 0
        for bits in levels:
            ranks.append(total + np.concatenate([[0], np.cumsum(bits)[:-1]]) if len(bits) else np.zeros(0, np.int64))
            total += int(bits.sum())
        self.ranks, self.size = ranks, total

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        left, levels = h, []
        while len(left):
            if len(levels) >= 64:
                raise ValueError("two keys have the same hash")
            size = max(int(len(left) * GAMMA), 2)
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level knows it. An unknown key may get a slot: compare fingerprints."""
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for k, bits in enumerate(self.levels):
            at = (_mixed(h[open_], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.ranks[k][at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *[len(b) for b in self.levels]], "<u8").tobytes()
        return head + b"".join(np.packbits(b, bitorder="little").tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(data, "<u8", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u8", n, 8).tolist(), 8 * (n + 1), []
        for size in sizes:
            part = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(part, count=size, bitorder="little").astype(bool))
            at += len(part)
        return cls(levels), at


SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


def index_bytes(h: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    hashed, slots = PerfectHash.build(h), np.zeros(len(h), SLOT)
    at = hashed.slots(h)
    for name, values in (("fingerprint", fingerprints(h)), ("shard", shard), ("offset", offset), ("length", length)):
        slots[name][at] = values
    return hashed.to_bytes() + slots.tobytes()


def index_lookup(data: bytes, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, slot contents) for the hashes."""
    hashed, at = PerfectHash.from_bytes(data)
    slots = np.frombuffer(data, SLOT, hashed.size, at)
    where = hashed.slots(h)
    if not len(slots):
        return np.zeros(len(h), bool), np.zeros(len(h), SLOT)
    got = slots[np.maximum(where, 0)]
    return (where >= 0) & (got["fingerprint"] == fingerprints(h)), got


# ---------------------------------------------------------------- writing

@dataclass(frozen=True)
class TokenStore:
    """A written store. entries: key, ordinal, shard; manifest: a row per shard; index: a row per bucket that has keys,
    each with the number of buckets."""

    folder: str
    entries: DataFrame
    manifest: DataFrame
    index: DataFrame


def _shard_writer(folder: str, path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, name, offset, last, ordinal = TaskContext.get().partitionId(), None, "", 0, object(), 0
        encoder = tokens.encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        try:
            for batch in batches:
                keys, lengths, ordinals = batch.column(0).to_pylist(), [], []
                if not keys:
                    continue
                if out is None:
                    name = f"shards/{part:07d}-{uuid.uuid4().hex}.ids"
                    fs, at = file_system(f"{folder}/{name}")
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(at, compression=None)
                    out.write(MAGIC + encoder.width.to_bytes(8, "little"))
                for key, ids in zip(keys, tokens.encoded(batch.column(1).to_pylist(), path)):
                    out.write(ids)
                    out.write(end)
                    lengths.append(len(ids) // encoder.width + 1)
                    ordinal = ordinal + 1 if key == last else 0
                    last = key
                    ordinals.append(ordinal)
                ends = offset + np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ordinals, pa.int64()), pa.array([part] * len(keys), pa.int64()),
                     pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array([name] * len(keys))],
                    ["key", "local", "shard", "offset", "length", "file"],
                )
                offset = int(ends[-1])
        finally:
            if out is not None:
                out.close()

    return write


def write_store(
    docs: DataFrame, folder: str, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    end_id: int = 0, bucket_keys: int = BUCKET_KEYS,
) -> TokenStore:
    """Encodes every text, closes it with `end_id` and writes shards, index and manifest below `folder`."""
    spark, path = session(docs), tokenizer or tokens.default_path()
    kind = docs.schema[key].dataType.simpleString()
    rows = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .withColumns({"th": F.xxhash64("text"), "tie": F.rand(7)})
        .repartitionByRange("key", "th", "tie").sortWithinPartitions("key", "th", "tie").select("key", "text")
    )
    schema = f"key {kind}, local long, shard long, offset long, length long, file string"
    placed = written(map_arrow(rows, _shard_writer(folder, os.path.abspath(path), end_id), schema), "token-entries")
    last = F.max(F.struct("key", "local"))
    manifest = placed.groupBy("shard").agg(
        F.first("file").alias("file"), F.sum("length").alias("ids"), F.count(F.lit(1)).alias("documents"),
        F.min(F.struct("key"))["key"].alias("lo"), last["key"].alias("hi"), last["local"].alias("hi_local"),
    )
    # a key that spans shards goes on counting where the shard before has stopped
    manifest = with_prefix_sums(manifest, "shard", {"start": "ids"})
    run = Window.partitionBy("hi").orderBy("shard")
    manifest = manifest.withColumn("hi_so_far", F.sum(F.col("hi_local") + 1).over(run))
    before = Window.orderBy("shard")
    manifest = written(
        manifest.withColumn("base", F.when(F.lag("hi", 1).over(before).eqNullSafe(F.col("lo")) & (F.row_number().over(before) > 1), F.lag("hi_so_far").over(before)).otherwise(0)),
        "token-manifest",
    )
    buckets = max(1, -(-placed.count() // bucket_keys))
    named = placed.drop("file").join(manifest.select("shard", "lo", "base"), "shard")
    named = named.withColumn("ordinal", F.col("local") + F.when(F.col("key").eqNullSafe(F.col("lo")), F.col("base")).otherwise(0))
    named = named.withColumn("h", F.xxhash64("key", "ordinal")).withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        h = group["h"].to_numpy().view(np.uint64)
        name = f"index/{bucket:07d}-{uuid.uuid4().hex}.mph"
        write_file(f"{folder}/{name}", [index_bytes(h, *(group[c].to_numpy() for c in ("shard", "offset", "length")))])
        return pd.DataFrame({"bucket": [bucket], "index_file": [name], "keys": [len(h)], "buckets": [buckets]})

    index = named.select("bucket", "h", "shard", "offset", "length").groupBy("bucket").applyInPandas(
        build, "bucket long, index_file string, keys long, buckets long"
    )
    return TokenStore(folder, named.select("key", "ordinal", "shard"), manifest, written(index, "token-index"))


# ---------------------------------------------------------------- reading

def lookup(store: TokenStore, wanted: DataFrame) -> DataFrame:
    """Places of the wanted (key, ordinal) rows through the index: key, ordinal, shard, offset, length. Keys that
    the store lacks give no row."""
    folder = store.folder
    kind = wanted.schema["key"].dataType.simpleString()
    # hash buckets without any key have no index file, so each file's line has the number of buckets
    buckets = store.index.agg(F.max("buckets")).first()[0] or 1
    asked = wanted.select("key", "ordinal").withColumn("h", F.xxhash64("key", F.col("ordinal").cast("long")))
    asked = asked.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets))).join(store.index, "bucket")

    def find(group: pd.DataFrame) -> pd.DataFrame:
        with open_file(f"{folder}/{group['index_file'].iloc[0]}") as file:
            data = file.read()
        found, got = index_lookup(data, group["h"].to_numpy().view(np.uint64))
        return pd.DataFrame({
            "key": group["key"], "ordinal": group["ordinal"], "shard": got["shard"].astype("i8"),
            "offset": got["offset"].astype("i8"), "length": got["length"].astype("i8"),
        })[found]

    return asked.groupBy("bucket").applyInPandas(
        find, f"key {kind}, ordinal long, shard long, offset long, length long"
    )


def read_digests(store: TokenStore, places: DataFrame, complete: bool = False) -> DataFrame:
    """Reads the ids at the places from the raw files: key, ordinal, start (ids of the store before it), n_tokens,
    ids_crc32. A shard's documents are read in one task, one after another. `complete` places are those of the whole
    store: a shard of which some are missing is an error then."""
    folder = store.folder
    kind = places.schema["key"].dataType.simpleString()

    def read(group: pd.DataFrame) -> pd.DataFrame:
        group, sums = group.sort_values("offset"), []
        if complete and (found := int(group["length"].notna().sum())) != (all_ := int(group["documents"].iloc[0])):
            raise ValueError(f"the index finds {found} of the {all_} documents of {group['file'].iloc[0]}")
        with open_file(f"{folder}/{group['file'].iloc[0]}") as file:
            head = file.read(HEADER)
            if head[:8] != MAGIC:
                raise ValueError("not a file of token ids")
            dtype = np.dtype(f"u{int.from_bytes(head[8:], 'little')}")
            for offset, length in zip(map(int, group["offset"]), map(int, group["length"])):
                if file.tell() != HEADER + offset * dtype.itemsize:
                    file.seek(HEADER + offset * dtype.itemsize)
                sums.append(tokens.crc_of_ids(np.frombuffer(file.read(length * dtype.itemsize), dtype)))
        return pd.DataFrame({
            "key": group["key"], "ordinal": group["ordinal"], "start": group["start"] + group["offset"],
            "n_tokens": group["length"], "ids_crc32": sums,
        })

    rows = store.manifest.select("shard", "file", "start", "documents").join(places, "shard", "left" if complete else "inner")
    return rows.groupBy("shard").applyInPandas(read, f"key {kind}, ordinal long, start long, n_tokens long, ids_crc32 long")


def open_keys(spark: SparkSession, store: TokenStore) -> DataFrame:
    """All (key, ordinal) rows of the store."""
    return store.entries.select("key", "ordinal")
