"""Sorting, top-k and de-duplication."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order(df: DataFrame, by: list[tuple[str, bool]]) -> DataFrame:
    """Sort for display; each entry is (column, ascending)."""
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in by])


def order_desc(df: DataFrame, column: str) -> DataFrame:
    return order(df, [(column, False)])


def oldest(df: DataFrame, n: int | None = None, by: str = "tweet_date", tiebreak: str = "tweet_id") -> DataFrame:
    """Oldest rows first; a limit gives a distributed top-k, none keeps every row."""
    out = df.orderBy(F.col(by).asc(), F.col(tiebreak).asc())
    return out if n is None else out.limit(n)


def most_negative(df: DataFrame, n: int = 5, tiebreak: tuple[str, ...] = ("source", "keywords")) -> DataFrame:
    """The n rows with the lowest sentiment, as a distributed top-k."""
    return (
        df.where(F.col("sentiment") < 0)
        .orderBy(F.col("sentiment").asc(), *[F.col(c).asc() for c in tiebreak])
        .limit(n)
    )


def negative_count(df: DataFrame) -> DataFrame:
    return df.where(F.col("sentiment") < 0).agg(F.count(F.lit(1)).alias("negative_rows"))


def head(df: DataFrame, n: int, *by: str) -> DataFrame:
    """The first n rows; without an order any n."""
    return (df.orderBy(*by) if by else df).limit(n)


def numbered(df: DataFrame, by: list[tuple[str, bool]], path: str, name: str = "POSITION") -> DataFrame:
    """Each row's place, from 1, in the order ``by``; ties get places in any order, so end ``by`` with a key.

    The rows are dealt by range, sorted, and written to ``path`` with their place within their partition. The only
    thing that crosses partitions is one row count of each; their running totals turn the places into global ones.
    """
    spark, at = df.sparkSession, F.monotonically_increasing_id()  # partition in the upper 31 bits, row in the lower 33
    order(df, by).withColumn("_at", at).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])).parquet(path)
    part = F.shiftrightunsigned("_at", 33)
    counts = sorted(map(tuple, rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1))).collect()))
    before = accumulate((n for _, n in counts), initial=0)
    bases = spark.createDataFrame([(p, n) for (p, _), n in zip(counts, before)], "_part long, _base long")
    place = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return rows.withColumn("_part", part).join(F.broadcast(bases), "_part").withColumn(name, place).drop("_part", "_at", "_base")


def dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_on(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key, the first in the order of ``by``.

    The minimum of a struct combines map-side: a key that owns a third of the rows reaches the
    shuffle as one candidate per task, where a ranking window would sort all its copies together.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    best = F.min(F.struct(*[F.col(c) for c in [*by, *rest]])).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])
