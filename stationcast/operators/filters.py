"""Row filters; each is one predicate that Spark can push to the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import norm


def by_run(df: DataFrame, run_date_id: int) -> DataFrame:
    return df.where(F.col("RUN_DATE_ID") == run_date_id)


def by_run_range(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.where(F.col("RUN_DATE_ID").between(first, last))


def affiliate_or_mega(sap: DataFrame) -> DataFrame:
    return sap.where(
        (norm("DISTRIBUTION_CHANNEL") == "affiliate station") | norm("DELIVERY_STATION").like("% mega %")
    )


def require(df: DataFrame, *cols: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def for_station(df: DataFrame, station: str, column: str = "STATION") -> DataFrame:
    return df.where(F.col(column) == station)


def complete_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=cols)


def negative(df: DataFrame, column: str = "sentiment") -> DataFrame:
    return df.where(F.col(column) < 0)


def is_empty(df: DataFrame) -> bool:
    """Whether a batch has no row; sinks skip it then."""
    return df.isEmpty()
