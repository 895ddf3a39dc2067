"""Incremental variants of the daily loads on Structured Streaming, run to completion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Feed
from ..sources.feeds import with_lineage
from ..sources.layers import append_once, read_layer_or_none, write_full
from ..sources.versions import clean, delete, path_missing


def stream_landing(
    spark: SparkSession, feed: Feed, directory: str, checkpoint: str, sink: Callable[[DataFrame, int], None]
) -> None:
    """Hand only the landing files not seen before to the sink. A batch whose sink died is handed over
    again, so a sink must be repeatable: ``append_batches`` is, and so is ``layers.write_replace``. A header that differs
    from the contract is an error. Files may be compressed, as for the daily loads."""
    source = (
        spark.readStream.schema(feed.schema).option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv{,.gz,.bz2,.deflate,.zst,.lz4,.snappy}").csv(directory)
    )
    query = (
        with_lineage(source).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def daily_totals(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Streaming daily sales totals; rows later than the watermark are dropped by Spark."""
    return (
        events.withWatermark("SALES_TS", lateness)
        .groupBy(F.window("SALES_TS", "1 day"), "STATION")
        .agg(F.sum("VOLUME").alias("TOTAL_VOLUME_SOLD"), F.sum("SALES_VALUE").alias("TOTAL_SALES_VALUE"))
        .select("STATION", F.to_date("window.start").alias("SALES_DATE"), "TOTAL_VOLUME_SOLD", "TOTAL_SALES_VALUE")
    )


def first_seen(articles: DataFrame, keys: list[str], lateness: str = "7 days", at: str = "createdAt") -> DataFrame:
    """First article per key within the lateness bound."""
    return articles.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)


def append_batches(
    path: str, stream: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Sink that adds each batch's rows to a layer exactly once. The layer's manifest is the ledger of (stream, batch): its
    line is what makes the rows visible, so a batch is either in both or in neither."""

    def sink(batch: DataFrame, number: int) -> None:
        append_once(prepare(batch), path, f"{stream}-{number}", by)

    return sink


def upsert_totals(path: str, keys: list[str], keep: int = 8) -> Callable[[DataFrame, int], None]:
    """Sink of an update-mode aggregate: each batch's changed rows in a folder of its own, so a batch that is
    handed over again replaces itself. ``latest_totals`` reads them back.

    Every ``keep`` batches the last row of each key goes into a new generation, ``<path>.merged``, which says up to which
    batch it goes; folders that the generation before has taken in are deleted. So there are at most twice ``keep``
    folders, and a reader of the generation before still finds what it has listed."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        taken = _taken(spark, f"{path}.merged")
        if number - taken < keep:
            return
        last = _latest(_all_rows(spark, path, taken, number), keys, [c for c in batch.columns if c not in keys])
        write_full(last.withColumn("_upto", F.lit(number).cast("long")), f"{path}.merged")
        clean(spark, f"{path}.merged", keep=2)
        delete(spark, [f"{path}/batch={n}" for n in range(max(taken - 4 * keep, 0), taken + 1)])

    return sink


def _taken(spark: SparkSession, path: str) -> int:
    """The last batch of the current generation."""
    merged = read_layer_or_none(spark, path)
    upto = None if merged is None else merged.agg(F.max("_upto")).first()[0]
    return -1 if upto is None else upto


def _all_rows(spark: SparkSession, path: str, taken: int, last: int | None = None) -> DataFrame:
    """The generation's rows and those of the batches since, each with its batch."""
    merged = read_layer_or_none(spark, f"{path}.merged")
    rows = None if merged is None else merged.withColumnRenamed("_upto", "batch")
    try:
        recent = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long")).where(F.col("batch") > taken)
    except AnalysisException as exc:
        if not path_missing(exc) or rows is None:
            raise
        return rows
    if last is not None:
        recent = recent.where(F.col("batch") <= last)
    return recent if rows is None else rows.unionByName(recent)


def _latest(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    last = F.max_by(F.struct(*values), "batch")
    return rows.groupBy(*keys).agg(last.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def latest_totals(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of each key; the choice is a map-side maximum."""
    rows = _all_rows(spark, path, _taken(spark, f"{path}.merged"))
    return _latest(rows, keys, [c for c in rows.columns if c not in (*keys, "batch")])
