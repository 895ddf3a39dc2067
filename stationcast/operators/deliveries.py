"""Delivery windows: from one delivery to the next of the same station and material."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import days, days_between

KEYS = ["STATION", "MATERIAL"]


def next_delivery(
    df: DataFrame, keys: list[str] = KEYS, date: str = "DELIVERY_DATE", tiebreak: str = "RECORD_ID",
    name: str = "DATE_LAG",
) -> DataFrame:
    """Date of the delivery that follows, null for the latest.

    Of several deliveries on one day, the one with the largest ``tiebreak`` (unique per delivery)
    is followed by the next day's, the others by their own date. The window runs over distinct
    days only, so a station and material that hold a large share of all rows still give a window
    group no longer than the calendar; the per-day reduction combines map-side.
    """
    spot = (
        df.where(F.col(date).isNotNull())
        .groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col(date).alias("_day"))
        .agg(F.max(tiebreak).alias("_last"))
    )
    w = Window.partitionBy(*[f"_{k}" for k in keys]).orderBy("_day")
    spot = spot.withColumn("_next", F.lead("_day").over(w))
    cond = reduce(
        lambda a, b: a & b,
        [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys] + [df[date] == F.col("_day")],
    )
    follows = F.when(F.col(tiebreak) == F.col("_last"), F.col("_next")).otherwise(F.col(date))
    return df.join(spot, cond, "left").select(*df.columns, follows.alias(name))


def gap_days(df: DataFrame, date: str = "DELIVERY_DATE", nxt: str = "DATE_LAG") -> DataFrame:
    return df.withColumn("NEXT_DELIVERY_DAYS", days_between(nxt, date))


def window_end(df: DataFrame, date: str = "DELIVERY_DATE", nxt: str = "DATE_LAG") -> DataFrame:
    """The latest delivery's window ends on its own day."""
    return df.withColumn(nxt, F.coalesce(F.col(nxt), F.col(date)))


def explode_days(
    df: DataFrame, start: str = "DELIVERY_DATE", end: str = "DATE_LAG", closed: str = "both",
    name: str = "SALES_DATE",
) -> DataFrame:
    """One row per day of the window. ``closed="left"`` leaves the boundary day to the next window."""
    stop = F.col(end)
    if closed == "left":
        stop = F.when(F.col(end) > F.col(start), F.date_sub(F.col(end), 1)).otherwise(F.col(end))
    return df.withColumn(name, F.explode(days(start, stop)))


def sales_days(deliveries: DataFrame, closed: str = "both") -> DataFrame:
    """Every delivery repeated for each sales day until the next one."""
    return explode_days(window_end(gap_days(next_delivery(deliveries))), closed=closed)


def sales_in_window(deliveries: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales with the delivery whose window they fall in: expanded days, then an equi-join."""
    spans = sales_days(deliveries).select(
        F.col("RECORD_ID").alias("DELIVERY_ID"), "STATION", F.col("MATERIAL").alias("PRODUCT"), "SALES_DATE",
        "DELIVERY_DATE",
    )
    return sales.join(spans, ["STATION", "PRODUCT", "SALES_DATE"], "inner")


def latest_rows(df: DataFrame, keys: list[str] = KEYS, date: str = "DELIVERY_DATE") -> DataFrame:
    """All rows of the latest date per key; ties survive. The maximum combines map-side."""
    return df.join(latest_delivery(df, keys, date), [*keys, date], "inner")


def latest_delivery(df: DataFrame, keys: list[str] = KEYS, date: str = "DELIVERY_DATE") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(date).alias(date))


def order_counts(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("STATION", "MATERIAL", "DELIVERY_DATE", "QUANTITY").agg(
        F.count("QUANTITY").alias("COUNT_OF_NEW_ORDERS")
    )
