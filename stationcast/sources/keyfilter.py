"""Bloom filters of published keys, one per partition, kept beside a table.

A filter is rows (partition, word, bits) of a bitmap; filters of several appends merge by OR, so an append only adds its own
rows to ``<table>.keys``. It is written before the data, so it never lacks a key that is published; a key that it does
not hold is new for certain, and one that it may hold is looked up in the partitions whose filters say so.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import path_missing

#: Bits of a partition's filter, and of a key: one key in a hundred is looked up for nothing at 100,000 keys a partition.
BITS, HASHES = 1 << 20, 5
#: One key in so many is looked up first.
FIRST = 64
LAYOUT = "part string, word int, bits long"


def _spots(keys: list[str]) -> Column:
    """The bits of a row's trimmed keys; a null key is a key."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.trim(F.col(k).cast("string"))), F.lit("n")) for k in keys]
    first, second = F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)
    return F.array(*[F.pmod(first.bitwiseXOR(F.shiftrightunsigned(first, 17)) % BITS + i * (second % BITS), F.lit(BITS)) for i in range(HASHES)])


def _part(by: str | None) -> Column:
    return (F.col(by) if by else F.lit(None)).cast("string").alias("part")


def add_keys(df: DataFrame, path: str, keys: list[str], by: str | None) -> None:
    """Adds the rows' keys to the filters."""
    spots = df.select(_part(by), F.explode(_spots(keys)).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    words = spots.groupBy("part", F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    words.write.mode("append").parquet(f"{path}.keys")


def has_filter(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(f"{path}.keys")
    except AnalysisException as exc:
        if path_missing(exc):
            return False
        raise
    return True


def candidate_parts(df: DataFrame, path: str, keys: list[str]) -> list[str | None]:
    """The partitions that may hold a key of the rows: as many as the table has at most, none where all keys are new.

    One candidate is enough for a partition. So a few of the keys are looked up first, and the rest only in the partitions
    that have none of them: a large batch is not multiplied by the partitions of a table that it is published in."""
    spark = df.sparkSession
    held = spark.read.schema(LAYOUT).parquet(f"{path}.keys")
    left = {r.part for r in held.select("part").distinct().collect()}
    spots = df.select(_spots(keys).alias("spots")).distinct()
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    found: set[str | None] = set()
    for some in (spots.where(F.col("spots")[0] % FIRST == 0), spots):
        if not left:
            break
        known = [p for p in left if p is not None]
        open_parts = (F.col("part").isin(known) if known else F.lit(False)) | (F.col("part").isNull() if None in left else F.lit(False))
        words = held.where(open_parts).groupBy("part", "word").agg(F.bit_or("bits").alias("bits"))
        each = some.select("spots", F.explode("spots").alias("at")).withColumn("word", F.shiftright("at", 6).cast("int"))
        # filters of many partitions are no table to broadcast, however well their files are compressed
        hits = each.join(words.hint("merge"), "word").where(F.col("bits").bitwiseAND(bit) != 0)
        whole = hits.groupBy("part", "spots").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES)
        new = {r.part for r in whole.select("part").distinct().collect()}
        found |= new
        left -= new
    return list(found)
