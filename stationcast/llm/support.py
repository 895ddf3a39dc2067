"""Shared folders, written tables and files, bounded batches, counts that survive lost executors."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of the contracts: a run of anything but blanks and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"
ARROW_BYTES = 4 << 20


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without one gets a temporary folder; a cluster
    without one is an error, since executors cannot see each other's local disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="stationcast-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared root."""
    _MADE.append(f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clean_up(spark: SparkSession) -> int:
    """Deletes every folder that this driver has got from `scratch`, once the results have been written elsewhere: frames
    that still read them end. Returns how many there were."""
    gone, conf = 0, spark.sparkContext._jsc.hadoopConfiguration()
    while _MADE:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here and every reader sees the same rows."""
    path = scratch(session(df), name)
    df.write.parquet(path, compression=compression)
    return session(df).read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the bytes of one Arrow batch, whatever the length of the texts."""
    session(df).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    return small_batches(df).mapInArrow(fn, schema)


def runs(texts: Iterable[str | None], most: int = 1 << 21) -> Iterator[list[str]]:
    """The texts in runs of about `most` characters; null texts are empty."""
    run, size = [], 0
    for text in texts:
        run.append(text or "")
        size += len(run[-1])
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def per_process(name: str, make: Callable[[], object]):
    """One object per Python worker. Task code is pickled by value, so module globals do not outlive a task."""
    kept = sys.__dict__.setdefault("_stationcast_llm", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def file_system(uri: str):
    """pyarrow's file system and path for a folder that Spark names by a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_file(uri: str, parts: Iterable[bytes]) -> int:
    """Streams the parts into a new file; returns its size."""
    fs, path = file_system(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    size = 0
    with fs.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    return size


def open_file(uri: str):
    fs, path = file_system(uri)
    return fs.open_input_file(path)


def with_prefix_sums(parts: DataFrame, order: str, columns: dict[str, str]) -> DataFrame:
    """Running totals before each row of a table that has one row per written file."""
    from pyspark.sql import Window

    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns({new: F.coalesce(F.sum(old).over(before), F.lit(0)) for new, old in columns.items()})


def schema_of(df: DataFrame, *columns: str) -> T.StructType:
    return T.StructType([df.schema[c] for c in columns])
