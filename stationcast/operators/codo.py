"""Company-operated station features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_key
from ..run import RunContext
from ..schemas import CODO_AGG, CODO_RAW
from .aggregates import daily_sales, daily_with_profile, meter_profile, station_tanks
from .deliveries import latest_delivery, latest_rows, order_counts, sales_days
from .joins import outer_chain, outer_left
from .shaping import with_audit

DAY_KEYS = ["STATION", "PRODUCT", "SALES_DATE"]


def with_months(df: DataFrame) -> DataFrame:
    return df.withColumns({"SALES_MONTH": month_key("SALES_DATE"), "DELIVERY_MONTH": month_key("DELIVERY_DATE")})


def combine_codo(days: DataFrame, stock: DataFrame, meter: DataFrame) -> DataFrame:
    """Delivery days, tank dips and meter readings matched on station, product and day."""
    d = days.select(
        "STATION", F.col("MATERIAL").alias("PRODUCT"), "SALES_DATE", "MATERIAL", "QUANTITY",
        F.col("STATUS").alias("TRUCK_DELIVERY_STATUS"), "DELIVERY_DATE",
        F.col("DATE_CREATED").alias("TRUCK_DELIVERY_DATE_CREATED"), "DATE_LAG", "NEXT_DELIVERY_DAYS",
    )
    s = stock.select(
        *DAY_KEYS, "TANK_DESCRIPTION", "DIP_READING", F.col("STATUS").alias("STOCK_VOLUME_STATUS"),
        F.col("DATE_CREATED").alias("STOCK_VOLUME_DATE_CREATED"),
    )
    m = meter.select(
        *DAY_KEYS, "METER_DESCRIPTION", "PREVIOUS_READING", "CURRENT_READING", "VOLUME", "TYPE",
        "UNIT_PRICE", "SALES_VALUE", "DEALER_COMMISSION", "DEALER_COMMISSION_AMOUNT",
        F.col("STATUS").alias("METER_READING_STATUS"),
        F.col("DATE_CREATED").alias("METER_READING_DATE_CREATED"),
    )
    return outer_chain([d, s, m], DAY_KEYS).select(*CODO_RAW)


def codo_raw(deliveries: DataFrame, stock: DataFrame, meter: DataFrame, run: RunContext) -> DataFrame:
    return with_audit(with_months(combine_codo(sales_days(deliveries), stock, meter)), run)


def daily_station_product(deliveries: DataFrame, stock: DataFrame, meter: DataFrame) -> DataFrame:
    """Volume per station, product, day and delivery, as ``aggregates.daily_station_product`` over the combined rows,
    without producing them.

    The combined table holds each meter row once for every delivery and tank row of its day. So each feed
    is folded to its keys first, and the sum of a volume over the combinations is its own sum times
    the row counts of the others; a feed without rows of a key counts once.
    """
    d = sales_days(deliveries).groupBy("STATION", F.col("MATERIAL").alias("PRODUCT"), "SALES_DATE", "QUANTITY", "NEXT_DELIVERY_DAYS").agg(
        F.count(F.lit(1)).alias("_d")
    )
    s = stock.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("_s"))
    m = meter.groupBy(*DAY_KEYS).agg(F.sum("VOLUME").alias("_sum"), F.count("VOLUME").alias("_n"))
    # one row per key and feed (for deliveries: per quantity and gap), so the joins are bounded
    both = outer_chain([d, s, m], DAY_KEYS, bounded=True)
    times = F.coalesce("_d", F.lit(1)) * F.coalesce("_s", F.lit(1))
    return both.groupBy(*DAY_KEYS, "QUANTITY", "NEXT_DELIVERY_DAYS").agg(
        F.sum(F.col("_sum") * times).alias("TOTAL_VOLUME_SOLD"),
        F.round(F.sum(F.col("_sum") * times) / F.nullif(F.sum(F.col("_n") * times), F.lit(0)), 2).alias("AVG_VOLUME_SOLD_PER_DAY"),
    )


# ---- volume sold after the latest delivery -----------------------------------

def sales_after(joined: DataFrame, delivery: str = "DELIVERY_DATE", sales: str = "SALES_DATE", kind: str = "TYPE") -> DataFrame:
    return joined.where((F.col(sales) > F.col(delivery)) & (F.col(kind) == "Sales"))


def sales_since_latest(deliveries: DataFrame, meter: DataFrame) -> DataFrame:
    """Latest deliveries joined to the meter sales after them; Spark folds the filter into the join."""
    cur = latest_rows(deliveries).select("STATION", "MATERIAL", "DELIVERY_DATE", "QUANTITY")
    m = meter.select(
        F.col("STATION").alias("_s"), F.col("PRODUCT").alias("_p"), "SALES_DATE", "TYPE", "VOLUME"
    )
    joined = cur.join(m, (F.col("STATION") == F.col("_s")) & (F.col("MATERIAL") == F.col("_p")), "inner")
    return sales_after(joined).drop("_s", "_p")


def sold_since(joined: DataFrame) -> DataFrame:
    return joined.groupBy(
        "STATION", "MATERIAL", F.col("DELIVERY_DATE").alias("CURRENT_DELIVERY_DATE"),
        F.col("QUANTITY").alias("CURRENT_DELIVERED_QUANTITY"),
    ).agg(F.sum("VOLUME").alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE"))


def scarcity(deliveries: DataFrame, meter: DataFrame) -> DataFrame:
    """Same rows as ``sold_since(sales_since_latest(...))`` with both sides reduced before they meet.

    Meter rows first shrink to one row per station, product and day; the volume after the latest
    delivery is then one number per station and material, repeated for each delivery of that day.
    """
    per_day = (
        meter.where(F.col("TYPE") == "Sales")
        .groupBy("STATION", F.col("PRODUCT").alias("MATERIAL"), "SALES_DATE")
        .agg(F.sum("VOLUME").alias("_v"))
    )
    latest = latest_delivery(deliveries)
    sold = (
        per_day.join(latest, ["STATION", "MATERIAL"], "inner")
        .where(F.col("SALES_DATE") > F.col("DELIVERY_DATE"))
        .groupBy("STATION", "MATERIAL", "DELIVERY_DATE")
        .agg(F.sum("_v").alias("_sold"))
    )
    per_quantity = deliveries.groupBy("STATION", "MATERIAL", "DELIVERY_DATE", "QUANTITY").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    return per_quantity.join(sold, ["STATION", "MATERIAL", "DELIVERY_DATE"], "inner").select(
        "STATION", "MATERIAL", F.col("DELIVERY_DATE").alias("CURRENT_DELIVERY_DATE"),
        F.col("QUANTITY").alias("CURRENT_DELIVERED_QUANTITY"),
        (F.col("_sold") * F.col("_copies")).alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE"),
    )


def scarcity_with_orders(sc: DataFrame, orders: DataFrame) -> DataFrame:
    """Order counts first: they hold the hot keys, and left joins are the ones AQE splits. A scarcity row comes from a
    delivery that the orders are counted from, so a key never has more of them than of the orders beside it."""
    return outer_left(orders, sc, ["STATION", "MATERIAL"])


# ---- the wide station table ----------------------------------------------------

@dataclass(frozen=True)
class StationFactors:
    """The wide station table kept as its three independent parts.

    The published table pairs every order row, tank row and meter row of a station, so its size is
    a product of three counts per station. Each of its columns lives in exactly one part; the parts
    grow with the input, the product does not have to be stored.
    """

    orders: DataFrame
    tanks: DataFrame
    meters: DataFrame


def codo_factors(deliveries: DataFrame, stock: DataFrame, meter: DataFrame, exact: bool = True) -> StationFactors:
    """The parts of the wide table; ``exact=False`` replaces the medians by approximate ones.

    Every scarcity row comes from the deliveries the orders are counted from, so a left join is
    already the full outer join here.
    """
    return StationFactors(
        orders=order_counts(deliveries).join(scarcity(deliveries, meter), ["STATION", "MATERIAL"], "left"),
        tanks=station_tanks(stock),
        meters=daily_with_profile(daily_sales(meter), meter_profile(meter, exact)),
    )


def station_wide(*parts: DataFrame) -> DataFrame:
    """Station-level outer join of the parts, the largest first: its hot stations can be split.

    The result of detail parts is their product per station, so slice or aggregate them first; filters reach the parts.
    """
    return outer_chain(list(parts), ["STATION"], heavy_rows=0)


def _per_station(*parts: DataFrame) -> DataFrame:
    """Outer join of frames with one row per station."""
    return outer_chain(list(parts), ["STATION"], bounded=True)


def codo_agg(factors: StationFactors, run: RunContext | None = None) -> DataFrame:
    """The 31-column wide table as a lazy join over the parts.

    Meant to be filtered: predicates on station, material, tank, meter or dates are pushed into
    the scans of the parts they belong to. Use the summaries below for whole-table figures.
    """
    wide = station_wide(factors.orders, factors.tanks, factors.meters).select(*CODO_AGG)
    wide = with_months(wide)
    return with_audit(wide, run) if run else wide


def _order_groups(f: StationFactors, date: str) -> DataFrame:
    return f.orders.groupBy("STATION", "MATERIAL", date, "QUANTITY").agg(
        F.count(F.lit(1)).alias("_no"),
        F.max("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE").alias("_sold"),
    )


def _tank_groups(f: StationFactors) -> DataFrame:
    return f.tanks.groupBy("STATION").agg(
        F.count(F.lit(1)).alias("_nt"), F.max("TOTAL_STATION_CAPACITY").alias("TOTAL_STATION_CAPACITY")
    )


def _day_groups(f: StationFactors) -> DataFrame:
    volume = F.col("TOTAL_DAILY_VOLUME_PRODUCT_SOLD")
    return f.meters.groupBy("STATION", "SALES_DATE").agg(F.sum(volume).alias("_v"), F.max(volume).alias("_top"))


def _times(*names: str):
    """Product of row counts, an absent outer side counting once."""
    out = F.lit(1).cast("bigint")
    for n in names:
        out = out * F.coalesce(F.col(n), F.lit(1))
    return out


def station_volume(f: StationFactors) -> DataFrame:
    """Volume summary per order group and sales day, computed from the parts.

    Equal to grouping the wide table; its own grain still pairs order groups with days, so slice it
    by station or date, or take one of the two margins below for the whole table.
    """
    wide = station_wide(_order_groups(f, "CURRENT_DELIVERY_DATE"), _tank_groups(f), _day_groups(f))
    return wide.select(
        "STATION", "MATERIAL", "CURRENT_DELIVERY_DATE", "SALES_DATE", "TOTAL_STATION_CAPACITY", "QUANTITY",
        (F.col("_v") * _times("_no", "_nt")).alias("TOTAL_VOLUME_SOLD"),
        F.col("_sold").alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY"),
    )


def station_volume_max(f: StationFactors) -> DataFrame:
    """Peak meter-day volume per order group and sales day; same shape note as above."""
    wide = station_wide(_order_groups(f, "DELIVERY_DATE"), _tank_groups(f), _day_groups(f))
    return wide.select(
        "STATION", "MATERIAL", "DELIVERY_DATE", "SALES_DATE", "TOTAL_STATION_CAPACITY", "QUANTITY",
        F.col("_top").alias("TOTAL_VOLUME_SOLD"),
        F.col("TOTAL_STATION_CAPACITY").alias("MAX_STATION_CAPACITY"),
    )


def station_volume_by_order(f: StationFactors) -> DataFrame:
    """``station_volume`` folded over sales days, one row per order group."""
    days = _day_groups(f).groupBy("STATION").agg(
        F.count("SALES_DATE").alias("SALES_DAYS"), F.sum("_v").alias("_v"), F.max("_v").alias("_peak")
    )
    wide = station_wide(_order_groups(f, "CURRENT_DELIVERY_DATE"), _per_station(_tank_groups(f), days))
    return wide.select(
        "STATION", "MATERIAL", "CURRENT_DELIVERY_DATE", "TOTAL_STATION_CAPACITY", "QUANTITY", "SALES_DAYS",
        (F.col("_v") * _times("_no", "_nt")).alias("TOTAL_VOLUME_SOLD"),
        (F.col("_peak") * _times("_no", "_nt")).alias("PEAK_DAY_VOLUME_SOLD"),
        F.col("_sold").alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY"),
    )


def station_volume_by_day(f: StationFactors) -> DataFrame:
    """``station_volume`` folded over order groups, one row per station and sales day."""
    orders = _order_groups(f, "CURRENT_DELIVERY_DATE").groupBy("STATION").agg(
        F.count(F.lit(1)).alias("ORDER_GROUPS"), F.sum("_no").alias("_no"), F.max("_sold").alias("_sold")
    )
    wide = station_wide(_day_groups(f), _per_station(_tank_groups(f), orders))
    # Rows without a station never match each other in the join; the last grouping folds them.
    return wide.groupBy("STATION", "SALES_DATE", "TOTAL_STATION_CAPACITY").agg(
        F.max("ORDER_GROUPS").alias("ORDER_GROUPS"),
        F.sum(F.col("_v") * _times("_no", "_nt")).alias("TOTAL_VOLUME_SOLD"),
        F.sum("_v").alias("VOLUME_PER_ORDER_AND_TANK"),
        F.max("_sold").alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY"),
    )


def station_volume_max_by_order(f: StationFactors) -> DataFrame:
    """``station_volume_max`` folded over sales days."""
    days = _day_groups(f).groupBy("STATION").agg(
        F.count("SALES_DATE").alias("SALES_DAYS"), F.max("_top").alias("_top")
    )
    wide = station_wide(_order_groups(f, "DELIVERY_DATE"), _per_station(_tank_groups(f), days))
    return wide.select(
        "STATION", "MATERIAL", "DELIVERY_DATE", "TOTAL_STATION_CAPACITY", "QUANTITY", "SALES_DAYS",
        F.col("_top").alias("TOTAL_VOLUME_SOLD"),
    )


def station_wide_summary(f: StationFactors) -> DataFrame:
    """Row count and totals of the wide table per station, without building it."""
    orders = f.orders.groupBy("STATION").agg(
        F.count(F.lit(1)).alias("_no"), F.sum("COUNT_OF_NEW_ORDERS").alias("_orders")
    )
    tanks = f.tanks.groupBy("STATION").agg(
        F.count(F.lit(1)).alias("_nt"), F.sum("MAX_DEEP_READING").alias("_dips"),
        F.max("TOTAL_STATION_CAPACITY").alias("TOTAL_STATION_CAPACITY"),
        F.max("TOTAL_NUMBER_OF_TANKS").alias("TOTAL_NUMBER_OF_TANKS"),
    )
    meters = f.meters.groupBy("STATION").agg(
        F.count(F.lit(1)).alias("_nm"), F.sum("TOTAL_DAILY_VOLUME_PRODUCT_SOLD").alias("_v"),
        F.min("SALES_DATE").alias("FIRST_SALES_DATE"), F.max("SALES_DATE").alias("LAST_SALES_DATE"),
        F.max("MAX_VOLUME_PRODUCT_SOLD").alias("MAX_VOLUME_PRODUCT_SOLD"),
    )
    return _per_station(orders, tanks, meters).select(
        "STATION", _times("_no", "_nt", "_nm").alias("WIDE_ROWS"),
        (F.col("_orders") * _times("_nt", "_nm")).alias("COUNT_OF_NEW_ORDERS"),
        (F.col("_dips") * _times("_no", "_nm")).alias("MAX_DEEP_READING"),
        (F.col("_v") * _times("_no", "_nt")).alias("TOTAL_DAILY_VOLUME_PRODUCT_SOLD"),
        "TOTAL_NUMBER_OF_TANKS", "TOTAL_STATION_CAPACITY", "FIRST_SALES_DATE", "LAST_SALES_DATE",
        "MAX_VOLUME_PRODUCT_SOLD",
    )
