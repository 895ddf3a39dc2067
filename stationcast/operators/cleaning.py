"""Feed cleaning between bronze and silver: pure projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fx


def clean_created(df: DataFrame, name: str = "DATE_CREATED") -> DataFrame:
    return df.withColumn(name, fx.created_text(name))


def compact_date(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Business date text to a real date; layers are partitioned by it."""
    return df.withColumn(name, fx.parse_date(name, fmt))


def split_sales_date(df: DataFrame, name: str = "SALES_DATE") -> DataFrame:
    """``05/01/2023 7:05`` to a date and the time token."""
    return df.withColumns({
        "SALES_TIME": fx.token(name, " ", 1),
        name: fx.parse_date(name, fx.FEED_STAMP),
    })


def clean_doc_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "SAP_QUOTATION_NUMBER": fx.strip("SAP_QUOTATION_NUMBER", "'00"),
        "SHIPMENT_DOC_NUMBER": fx.strip("SHIPMENT_DOC_NUMBER", "'"),
        "DELIVERY_DOC_NUMBER": fx.strip("DELIVERY_DOC_NUMBER", "'"),
    })


def clean_quantities(df: DataFrame, cols: list[str], sentinel: float | None = -9999) -> DataFrame:
    """Comma numbers to doubles; the sentinel, when given, to null."""
    fix = fx.clean_double if sentinel is None else lambda c: fx.unless_sentinel(fx.clean_double(c), sentinel)
    return df.withColumns({c: fix(c) for c in cols})


def clean_states(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("SNO").alias("STATE_ID"),
        F.upper(fx.token("STATE", " ", 0)).alias("STATE_NAME"),
        F.upper("LOCAL_GOVERNMENT_AREA").alias("LOCAL_GOVERNMENT_AREA"),
    )


def strip_apostrophes(df: DataFrame, name: str = "DELIVERY_STATION") -> DataFrame:
    return df.withColumn(name, fx.strip(name, "'"))
