"""The exploratory joins over the raw feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_ci, join_id, pair_profile


def sap_dodo_by_name(sap: DataFrame, dodo: DataFrame) -> DataFrame:
    return join_ci(dodo, sap, "customer_name", "delivery_station")


def meter_stock_by_record(meter: DataFrame, stock: DataFrame) -> DataFrame:
    return join_id(meter, stock, "record_id", "record_id")


def meter_sap_by_document(meter: DataFrame, sap: DataFrame) -> DataFrame:
    return join_id(meter, sap, "record_id", "sales_document").where(F.col("record_id").isNotNull())


def name_matches(dodo: DataFrame, sap: DataFrame, trucks: DataFrame) -> DataFrame:
    """Size and totals of the three-way name join, aggregated before the join."""
    return pair_profile([
        (dodo, F.lower("customer_name"), {"quantity_sold": F.col("quantity_sold")}),
        (sap, F.lower("delivery_station"), {"quantity_ordered": F.col("quantity_ordered")}),
        (trucks, F.lower("station"), {"delivered": F.col("quantity")}),
    ], "station_name")


def station_matches(a: DataFrame, b: DataFrame, a_measures: dict, b_measures: dict, by=None) -> DataFrame:
    """Station-level join of two detail feeds as counts and sums per station."""
    return pair_profile([(a, F.col("station"), a_measures), (b, F.col("station"), b_measures)], "station", by)


def product_station(
    meter: DataFrame, stock: DataFrame, product: str, station: str
) -> DataFrame:
    """One station and product: what each (meter, tank) pair of the join holds."""
    m = meter.where((F.col("product") == product) & (F.col("station") == station))
    s = stock.where((F.col("product") == product) & (F.col("station") == station))
    return station_matches(
        m, s, {"volume": F.col("volume")}, {"dip_reading": F.col("dip_reading")},
        [["meter_description"], ["tank_description"]],
    )
