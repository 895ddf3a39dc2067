"""Stock and meter aggregates. All combine map-side, so a hot station shuffles partial rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_medians


def tank_max(stock: DataFrame) -> DataFrame:
    return stock.groupBy("STATION", "TANK_DESCRIPTION").agg(F.max("DIP_READING").alias("MAX_DEEP_READING"))


def capacity(per_tank: DataFrame) -> DataFrame:
    return per_tank.groupBy("STATION").agg(F.sum("MAX_DEEP_READING").alias("TOTAL_STATION_CAPACITY"))


def tank_count(stock: DataFrame, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return stock.groupBy("STATION").agg(count("TANK_DESCRIPTION").alias("TOTAL_NUMBER_OF_TANKS"))


def station_totals(per_tank: DataFrame) -> DataFrame:
    """Tank count and capacity from the per-tank rows, which already are distinct tanks."""
    return per_tank.groupBy("STATION").agg(
        F.count("TANK_DESCRIPTION").alias("TOTAL_NUMBER_OF_TANKS"),
        F.sum("MAX_DEEP_READING").alias("TOTAL_STATION_CAPACITY"),
    )


def tanks_join_capacity(tanks: DataFrame, cap: DataFrame) -> DataFrame:
    return tanks.join(cap, ["STATION"], "inner")


def with_tank_max(metrics: DataFrame, per_tank: DataFrame) -> DataFrame:
    return metrics.join(per_tank, ["STATION"], "inner")


def station_tanks(stock: DataFrame) -> DataFrame:
    """One row per tank with its station's tank count and capacity."""
    per_tank = tank_max(stock)
    return with_tank_max(station_totals(per_tank), per_tank)


def daily_sales(meter: DataFrame) -> DataFrame:
    return meter.groupBy("STATION", "METER_DESCRIPTION", "TYPE", "SALES_DATE").agg(
        F.sum("SALES_VALUE").alias("TOTAL_DAILY_SALES_VALUE"),
        F.sum("VOLUME").alias("TOTAL_DAILY_VOLUME_PRODUCT_SOLD"),
    )


PROFILE_KEYS = ["STATION", "METER_DESCRIPTION", "PRODUCT"]
PROFILE_MEDIANS = {
    "VOLUME": "MEDIAN_VOLUME_PRODUCT_SOLD",
    "SALES_VALUE": "MEDIAN_SALES_VALUE",
    "CURRENT_READING": "MEDIAN_CURRENT_READING",
    "PREVIOUS_READING": "MEDIAN_PREVIOUS_READING",
}


def meter_profile(meter: DataFrame, exact: bool = True) -> DataFrame:
    """Extremes, medians and totals per station, meter and product."""
    simple = [
        F.max("VOLUME").alias("MAX_VOLUME_PRODUCT_SOLD"), F.min("VOLUME").alias("MIN_VOLUME_PRODUCT_SOLD"),
        F.sum("SALES_VALUE").alias("TOTAL_SALES_VALUE"), F.max("SALES_VALUE").alias("MAX_SALES_VALUE"),
        F.min("SALES_VALUE").alias("MIN_SALES_VALUE"), F.max("CURRENT_READING").alias("MAX_CURRENT_READING"),
        F.min("CURRENT_READING").alias("MIN_CURRENT_READING"),
        F.max("PREVIOUS_READING").alias("MAX_PREVIOUS_READING"),
        F.min("PREVIOUS_READING").alias("MIN_PREVIOUS_READING"),
    ]
    if not exact:
        simple += [F.percentile_approx(F.col(c).cast("double"), 0.5).alias(n) for c, n in PROFILE_MEDIANS.items()]
        return meter.groupBy(*PROFILE_KEYS).agg(*simple)
    return exact_medians(meter, PROFILE_KEYS, PROFILE_MEDIANS, tuple(simple))


def daily_with_profile(daily: DataFrame, profile: DataFrame) -> DataFrame:
    """Both sides are aggregates (days x types, products per meter), so the outer join is bounded."""
    return daily.join(profile, ["STATION", "METER_DESCRIPTION"], "outer")


def daily_station_product(raw: DataFrame) -> DataFrame:
    return raw.groupBy("STATION", "PRODUCT", "SALES_DATE", "QUANTITY", "NEXT_DELIVERY_DAYS").agg(
        F.sum("VOLUME").alias("TOTAL_VOLUME_SOLD"),
        F.round(F.avg("VOLUME"), 2).alias("AVG_VOLUME_SOLD_PER_DAY"),
    )


def touched(df: DataFrame, column: str) -> DataFrame:
    """Distinct business dates of a batch."""
    return df.select(column).distinct()


distinct_values = touched


def observe_count(df: DataFrame, name: str):
    """Attach a row counter that rides along with the next action; returns (frame, observation)."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
