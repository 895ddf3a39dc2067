"""Layers as batches: what is current is named by a manifest, which is written last.

Each write puts its files into a folder of its own, ``<layer>/_batch=<id>/[<by>=<value>/]``, and then appends one small file
to ``<layer>.manifest``. A line of it names a partition, the batch that now holds it, and the smallest and largest
RUN_DATE_ID in it; a whole write also takes all earlier partitions out, an adding one leaves what its partitions have. So
a write that fails changes nothing that is read, all partitions of a batch appear at once, readers of the state before go on
reading its files, and a read of some runs opens only the partitions that can hold them. A batch may have a name: the
manifest is then the ledger in which a batch that comes again is found. One writer per layer; ``clean`` removes what is no
longer named, and a whole write of what is read (``layers.compact``) makes one batch of many.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "RUN_DATE_ID"
BATCH = "_batch"
MANIFEST = "version long, whole boolean, adds boolean, batch string, by string, value string, run_min long, run_max long, rows long, layout string"


def path_missing(exc: AnalysisException) -> bool:
    """No folder yet, or one without any file."""
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        spark.read.parquet(f"{path}.manifest")  # a schema that is given would hide that there is no such folder
    except AnalysisException as exc:
        if path_missing(exc):
            return None
        raise
    return spark.read.schema(MANIFEST).parquet(f"{path}.manifest")


def current(spark: SparkSession, path: str) -> list[Row] | None:
    """The lines of the partitions that are current: each one's last, and those that have added to it since; None for a
    layer without a manifest. Partitions are business dates or the like."""
    lines = _manifest(spark, path)
    if lines is None:
        return None
    since = lines.where("whole").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    held: dict[str | None, list[Row]] = {}
    for line in sorted(lines.where(F.col("version") >= since).collect(), key=lambda r: r.version):
        held[line.value] = [*held.get(line.value, []), line] if line.adds else [line]
    return [line for own in held.values() for line in own]


def newest_values(spark: SparkSession, path: str) -> list[str | None]:
    """The partition values of the layer's last batch, from the manifest: the batch itself is not read."""
    lines = _manifest(spark, path)
    last = lines.agg(F.max("version")).first()[0]
    return [r.value for r in lines.where((F.col("version") == last) & (F.col("rows") > 0)).select("value").distinct().collect()]


@contextmanager
def _spread(spark: SparkSession):
    """A batch of few rows in many partitions is many small files: its tasks are not merged down to one."""
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "1KB")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_batch(df: DataFrame, path: str, by: str | None, whole: bool, writer, adds: bool = False, name: str | None = None) -> bool:
    """Writes the rows by ``writer(df)`` into a new batch and makes it current: all of the layer if ``whole``, else only
    the partitions that it has, in place of what they had or, if it ``adds``, beside that. A batch of a ``name`` that
    the manifest already has is not written again; the answer tells whether it was."""
    spark, lines = df.sparkSession, _manifest(df.sparkSession, path)
    if name is not None and lines is not None and not lines.where(F.col("batch") == name).isEmpty():
        return False
    batch = name or f"b{uuid.uuid4().hex}"
    folder = f"{path}/{BATCH}={batch}"
    with _spread(spark):
        writer(df).mode("overwrite" if name else "error").parquet(folder)
    version = 1 if lines is None else (lines.agg(F.max("version")).first()[0] or 0) + 1
    held = spark.read.schema(df.schema).parquet(folder)
    runs = (F.col(RUN) if RUN in df.columns else F.lit(None)).cast("long")
    figures = [F.min(runs).alias("run_min"), F.max(runs).alias("run_max"), F.count(F.lit(1)).alias("rows")]
    value = (F.col(by) if by else F.lit(None)).cast("string").alias("value")
    found = held.groupBy(value).agg(*figures).collect()
    if not found and (whole or name):
        found = [Row(value=None, run_min=None, run_max=None, rows=0)]
    if found:
        rows = [(version, whole, adds, batch, by, r.value, r.run_min, r.run_max, r.rows, df.schema.json()) for r in found]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}.manifest")
    return True


def _layout(lines: list[Row]) -> T.StructType:
    """Columns of all current batches, the newest first where a type has changed."""
    fields: dict[str, T.StructField] = {}
    for layout in dict.fromkeys(r.layout for r in sorted(lines, key=lambda r: -r.version)):
        for field in T.StructType.fromJson(json.loads(layout)).fields:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


def overlapping(lines: list[Row], start: int | None, end: int | None) -> list[Row]:
    """Lines whose runs may lie in the range; those without run dates always may."""
    return [
        r for r in lines
        if r.run_min is None or ((start is None or r.run_max >= start) and (end is None or r.run_min <= end))
    ]


def read_current(spark: SparkSession, path: str, lines: list[Row], start: int | None = None, end: int | None = None) -> DataFrame:
    """The rows of the current partitions that can hold the runs; the others are cut off by partition filters, and a batch
    without any such partition is not even listed. Columns have the types they were written with."""
    chosen = overlapping([r for r in lines if r.rows], start, end)
    layout = _layout(lines)
    if not chosen:
        return spark.createDataFrame([], layout)
    by = chosen[0].by
    batches = sorted({r.batch for r in chosen})
    folders = [f"{path}/{BATCH}={b}" for b in batches]
    df = spark.read.schema(T.StructType([*layout.fields, T.StructField(BATCH, T.StringType())])).option("basePath", path).parquet(*folders)
    if by is not None:
        keep = F.lit(False)
        for b in batches:
            values = [r.value for r in chosen if r.batch == b]
            known = [v for v in values if v is not None]
            part = F.col(by).cast("string").isin(known) if known else F.lit(False)
            keep |= (F.col(BATCH) == b) & (part | F.col(by).isNull() if None in values else part)
        df = df.where(keep)
    return df.drop(BATCH)


def location(spark: SparkSession, path: str) -> str:
    """The folder of a layer that is one batch, or that has no manifest."""
    batches = {r.batch for r in current(spark, path) or [] if r.rows or r.whole}
    if len(batches) > 1:
        raise ValueError(f"{path} is spread over {len(batches)} batches; write it whole to publish its files")
    return f"{path}/{BATCH}={batches.pop()}" if batches else path


def delete(spark: SparkSession, folders: list[str]) -> int:
    """Deletes folders, those that are there; returns how many."""
    jvm, gone = spark.sparkContext._jvm, 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def clean(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes the batches that were last named by a version older than the last ``keep`` ones and are not current.
    Returns how many. Readers of a state that old lose its files."""
    lines = _manifest(spark, path)
    if lines is None:
        return 0
    ages = {r.batch: r.version for r in lines.groupBy("batch").agg(F.max("version").alias("version")).collect()}
    live = {r.batch for r in current(spark, path)}
    newest = max(ages.values(), default=0)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    listed = [s.getPath().getName() for s in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)]
    held = {n.removeprefix(f"{BATCH}=") for n in listed if n.startswith(f"{BATCH}=")}
    old = [b for b in held if b not in live and ages.get(b, 0) <= newest - keep]
    return delete(spark, [f"{path}/{BATCH}={b}" for b in old])
