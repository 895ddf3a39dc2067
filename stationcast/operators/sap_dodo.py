"""Loading report joined to dealer orders, with delivery metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import days_between, flag, weekday
from ..run import RunContext
from ..schemas import AUDIT_COLUMNS, SAP_DODO
from .filters import affiliate_or_mega
from .joins import outer_on
from .shaping import with_audit


def sap_full_dodo(sap: DataFrame, dodo: DataFrame) -> DataFrame:
    """Full outer join on the trimmed quotation number, duplicate pairs removed.

    A joined pair is a function of its two rows, so removing duplicates from each side first gives
    the same set, and keeps groups of copies from multiplying.
    """
    s, d = sap.drop(*AUDIT_COLUMNS), dodo.drop(*AUDIT_COLUMNS)
    shared = [c for c in d.columns if c in s.columns]
    d = d.withColumnsRenamed({c: f"DODO_{c}" for c in shared})
    return outer_on(s, d, F.trim("SALES_QUOTATION"), F.trim("SAP_QUOTATION_NUMBER"), distinct=True)


def tolerance_band(df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    ordered = F.col("QUANTITY_ORDERED")
    return df.withColumns({
        "QUANTITY_ORDERED_TEMP_TOLERANCE_MIN": ordered * F.lit(round(1 - tolerance, 10)),
        "QUANTITY_ORDERED_TEMP_TOLERANCE_MAX": ordered * F.lit(round(1 + tolerance, 10)),
    })


def within_band(df: DataFrame) -> DataFrame:
    inside = F.col("QUANTITY_DELIVERED").between(
        F.col("QUANTITY_ORDERED_TEMP_TOLERANCE_MIN"), F.col("QUANTITY_ORDERED_TEMP_TOLERANCE_MAX")
    )
    return df.withColumn("IS_QUANTITY_DELIVERED_WITHIN_TEMP_THRESHOLD", flag(inside))


def lead_times(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "DELIVERY_DAYS": days_between("DELIVERY_DATE", "SALES_DATE"),
        "ORDER_PROCESSING_DAYS": days_between("DISPATCH_DATE", "SALES_DATE"),
    })


def is_delayed(df: DataFrame, days: int = 5) -> DataFrame:
    return df.withColumn("DELIVERY_IS_DELAYED", flag(F.col("DELIVERY_DAYS") > days))


def in_transit(df: DataFrame) -> DataFrame:
    moving = F.col("DISPATCH_DATE").isNotNull() & F.col("DELIVERY_DATE").isNull() & F.col("COMPLETED_ON").isNull()
    return df.withColumn("IS_PRODUCT_IN_TRANSIST", flag(moving))


WEEKDAY_COLUMNS = {
    "DELIVERY_DATE": "DELIVERY_DATE_DAY_OF_WEEK",
    "DISPATCH_DATE": "DISPATCH_DATE_DAY_OF_WEEK",
    "COMPLETED_ON": "COMPLETED_ON_DATE_DAY_OF_WEEK",
    "SALES_DATE": "SALES_DATE_DAY_OF_WEEK",
}


def weekdays(df: DataFrame, cols: dict[str, str] = WEEKDAY_COLUMNS) -> DataFrame:
    return df.withColumns({name: weekday(c) for c, name in cols.items()})


def order_metrics(df: DataFrame) -> DataFrame:
    return in_transit(is_delayed(within_band(weekdays(lead_times(tolerance_band(df))))))


def sap_dodo(sap: DataFrame, dodo: DataFrame, run: RunContext) -> DataFrame:
    joined = order_metrics(sap_full_dodo(affiliate_or_mega(sap), dodo))
    return with_audit(joined.select(*SAP_DODO), run)
