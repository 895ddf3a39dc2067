"""Parquet layers and published tables.

Writes rebalance on the partition column first: AQE then sizes the files, splitting a hot date over
several tasks and packing small ones, so a partition never becomes one task or a thousand tiny files.
Layers are written in batches with a manifest (``versions``); catalog tables move to a new folder in one step.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import is_empty
from ..operators.joins import anti_trim
from ..operators.shaping import union_all, with_tag
from .keyfilter import add_keys, candidate_parts, has_filter
from .scratch import written
from .versions import RUN, current, location, path_missing, read_current, write_batch

LAYER_CODEC = "zstd"


def read_layer(
    spark: SparkSession, path: str, run_date: int | None = None, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Whole layer, one run, or an inclusive range of runs, open where an end is not given. Partitions that hold
    none of the runs are not opened."""
    if run_date is not None:
        start = run_date if start is None else max(start, run_date)
        end = run_date if end is None else min(end, run_date)
    lines = current(spark, path)
    df = spark.read.parquet(path) if lines is None else read_current(spark, path, lines, start, end)
    if start is not None:
        df = df.where(F.col(RUN) >= start)
    if end is not None:
        df = df.where(F.col(RUN) <= end)
    return df


def of_dates(df: DataFrame, by: str, dates: list[str | None]) -> DataFrame:
    """Only the given partitions; the predicate is on the partition column alone, so others are not listed."""
    known = [d for d in dates if d is not None]
    keep = F.col(by).cast("string").isin(known) if known else F.lit(False)
    return df.where(keep | F.col(by).isNull() if None in dates else keep)


def touched_dates(df: DataFrame, by: str) -> list[str | None]:
    """The partition values of a batch as text: business dates, so their number is bounded by the calendar."""
    return [r[0] for r in df.select(F.col(by).cast("string")).distinct().collect()]


def read_layer_or_none(spark: SparkSession, path: str, **kw) -> DataFrame | None:
    try:
        return read_layer(spark, path, **kw)
    except AnalysisException as exc:
        if path_missing(exc):
            return None
        raise


def read_tagged(spark: SparkSession, paths: dict[str, str], column: str = "STATION", **kw) -> DataFrame | None:
    """Stack one table per tag, each row tagged; tables that do not exist are skipped."""
    frames = []
    for tag, path in paths.items():
        df = read_layer_or_none(spark, path, **kw)
        if df is not None:
            frames.append(with_tag(df, column, tag))
    return union_all(*frames) if frames else None


def _writer(df: DataFrame, by: str | None, dealt: bool = False):
    """Layers repeat the feeds' text from step to step; Zstandard keeps them smaller than the default does."""
    if by is None:
        return df.write.option("compression", LAYER_CODEC)
    rows = df if dealt else df.hint("rebalance", by)
    return rows.write.option("compression", LAYER_CODEC).partitionBy(by)


def write_full(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replace the whole table, in one step once all is written."""
    write_batch(df, path, by, True, lambda rows: _writer(rows, by))


def write_replace(df: DataFrame, path: str, by: str, lineage: str | None = None, dealt: bool = False) -> None:
    """Replace only the partitions present in this batch, all of them in one step; running a day again changes
    nothing.

    With ``lineage``, the column naming each row's file, a partition keeps the rows of files that
    are not part of this batch: a later file with a late row of an earlier day, or another depot's
    file of the same day, adds to that day. Rows without a business date share one partition.

    ``dealt`` says that the rows come from a layer of the same partitions, row by row: a task then has the rows of few
    of them, in files of the right size, and nothing is shuffled.
    """
    if lineage is not None:
        df = _keep_other_files(df, path, by, lineage)
    write_batch(df, path, by, False, lambda rows: _writer(rows, by, dealt))


def append_once(df: DataFrame, path: str, name: str, by: str | None = None) -> bool:
    """Add the rows as the batch of that name. A batch that comes again, because its writer died before it could note
    that it was done, adds nothing; one that died while writing is written anew. Answers whether it was written."""
    return write_batch(df, path, by, False, lambda rows: _writer(rows, by), adds=True, name=name)


def compact(spark: SparkSession, path: str, by: str | None = None) -> None:
    """Make one batch of all that a layer has."""
    write_full(read_layer(spark, path), path, by)


def _keep_other_files(df: DataFrame, path: str, by: str, lineage: str) -> DataFrame:
    table = read_layer_or_none(df.sparkSession, path)
    if table is None:
        return df
    held = of_dates(table, by, touched_dates(df, by))
    files = df.select(F.col(lineage).alias("_file")).distinct()
    others = held.join(files, F.col(lineage).eqNullSafe(F.col("_file")), "left_anti")
    return df.unionByName(others.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in df.columns]))


def _unpublished(df: DataFrame, path: str, keys: list[str], by: str | None, published) -> DataFrame:
    """The rows whose keys are not published yet. ``published()`` are the rows that are; it is asked only for
    the partitions whose filters may hold a key of the batch, and not at all where all keys are new."""
    if not has_filter(df.sparkSession, path):
        add_keys(published(), path, keys, by)
    parts = candidate_parts(df, path, keys)
    if not parts:
        return df
    gold = published()
    return anti_trim(df, gold if by is None else of_dates(gold, by, parts), keys)


def append_new(df: DataFrame, gold_path: str, keys: list[str], by: str | None = None) -> None:
    """Append rows whose keys the table does not hold yet; an empty batch leaves no trace. Rows of the table are read
    only where the filters of its keys (``keyfilter``) say that a key may be there. The batch is computed once, whatever
    it takes to make it: what is asked of it then is asked of the rows written."""
    spark, df = df.sparkSession, written(df, "batch")
    if is_empty(df):
        return
    held = T.StructType([df.schema[c] for c in dict.fromkeys([*keys, *([by] if by else [])])])
    try:  # with the batch's types, so that partition values compare as they were written, and no file is asked for them
        gold = spark.read.schema(held).parquet(gold_path)
        fresh = _unpublished(df, gold_path, keys, by, lambda: gold)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        fresh = df
    fresh = fresh if fresh is df else written(fresh, "fresh")
    add_keys(fresh, gold_path, keys, by)
    _writer(fresh, by).mode("append").parquet(gold_path)


def append_raw(df: DataFrame, path: str) -> None:
    """Append captured records to the raw collection."""
    df.write.mode("append").json(path)


def _move(spark: SparkSession, table: str, folder: str) -> None:
    """Makes the folder the table's, in one step of the catalog if the table is there and its columns are the same. Its
    partitions are found in the folder, not kept in the catalog, so that there is only the one thing to change."""
    if spark.catalog.tableExists(table):
        want, have = spark.read.parquet(folder).schema, spark.table(table).schema
        if {(f.name, f.dataType) for f in want} == {(f.name, f.dataType) for f in have}:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")  # other columns: another table
    tracked = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(tracked)
    spark.conf.set(tracked, "false")
    try:
        spark.catalog.createTable(table, path=folder, source="parquet")
    finally:
        spark.conf.set(tracked, before)


def _home(spark: SparkSession, table: str) -> str:
    """Where a table lies in its database's folder."""
    database, _, name = table.rpartition(".")
    folder = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/{name}"


def publish(df: DataFrame, table: str, mode: str = "overwrite", keys: list[str] | None = None) -> None:
    """Publish to a catalog table. An overwrite fills a new folder and then moves the table there: a write that
    fails leaves the table as it was, and no reader meets it missing. Appends first drop rows whose keys are already
    there, so a replay adds nothing."""
    spark = df.sparkSession
    if mode == "overwrite":
        folder = f"{_home(spark, table)}.batches/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        _move(spark, table, folder)
        return
    if keys:
        df = written(df, "batch")  # computed once for all that is asked of it
    if is_empty(df):
        return
    if keys:
        filters = f"{_home(spark, table)}.batches/published"
        if spark.catalog.tableExists(table):
            fresh = _unpublished(df, filters, keys, None, lambda: spark.table(table))
            df = fresh if fresh is df else written(fresh, "fresh")
        add_keys(df, filters, keys, None)
    df.write.mode(mode).format("parquet").saveAsTable(table)


def publish_path(spark: SparkSession, path: str, table: str) -> None:
    """A catalog table over a layer's own files: nothing is written twice. Call it after each write."""
    _move(spark, table, location(spark, path))
