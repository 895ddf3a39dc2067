"""Landing to bronze to silver for every feed.

Bronze keeps the day's text under normalised headers; silver applies the typed contract. Both are
partitioned by business date. A batch replaces its own files' rows in the dates it contains and keeps
those of other files, so replays change nothing and late rows join their day. Silver reads back only
the dates of the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as sc
from ..operators.cleaning import (
    clean_created, clean_doc_ids, clean_quantities, clean_states, compact_date, split_sales_date,
)
from ..operators.shaping import apply_contract, fix_unnamed, normalize_headers, rename, with_audit
from ..run import RunContext
from ..sources.feeds import day_range, read_dated_headers, read_landing, with_lineage
from ..sources.layers import of_dates, read_layer, read_tagged, write_full, write_replace
from ..sources.versions import newest_values
from .lake import Lake


def to_bronze(raw: DataFrame, feed: sc.Feed, run: RunContext) -> DataFrame:
    df = normalize_headers(rename(raw, feed.renames))
    if feed is sc.DODO_ORDERS:
        df = split_sales_date(df)
    else:
        df = compact_date(df, feed.date_column, feed.date_format)
    return with_audit(df, run)


def _sap(df: DataFrame) -> DataFrame:
    df = clean_quantities(df, sc.SAP_QUANTITIES)
    for name in ("DISPATCH_DATE", "DELIVERY_DATE"):
        df = compact_date(df, name)
    return apply_contract(df, [*sc.SAP_COLUMNS, "FILE_NAME"])


def _dodo(df: DataFrame) -> DataFrame:
    df = clean_quantities(clean_doc_ids(df), sc.DODO_QUANTITIES)
    typed = {"AMOUNT_PAID": "double", "COMPLETED_ON": "date"}
    return apply_contract(df, [(c, c, typed[c]) if c in typed else c for c in sc.DODO_COLUMNS])


def _typed(df: DataFrame, columns: list[str], types: dict[str, str]) -> DataFrame:
    return apply_contract(df, [(c, c, types[c]) if c in types else c for c in [*columns, "FILE_NAME"]])


def _stock(df: DataFrame) -> DataFrame:
    return _typed(clean_created(df), sc.STOCK_COLUMNS, {"DIP_READING": "int"})


def _meter(df: DataFrame) -> DataFrame:
    doubles = ["VOLUME", "UNIT_PRICE", "SALES_VALUE", "DEALER_COMMISSION", "DEALER_COMMISSION_AMOUNT"]
    df = clean_quantities(clean_created(df), doubles, sentinel=None)
    return _typed(df, sc.METER_COLUMNS, {"PREVIOUS_READING": "int", "CURRENT_READING": "int"})


def _trucks(df: DataFrame) -> DataFrame:
    return _typed(clean_quantities(clean_created(df), ["QUANTITY"], sentinel=None), sc.TRUCK_COLUMNS, {})


def _pdo(df: DataFrame) -> DataFrame:
    return _typed(df, sc.PDO_COLUMNS, {})


SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    sc.PDO_LOADING.name: _pdo,
    sc.SAP_LOADING.name: _sap,
    sc.DODO_ORDERS.name: _dodo,
    sc.CODO_STOCK.name: _stock,
    sc.CODO_METER.name: _meter,
    sc.CODO_TRUCKS.name: _trucks,
}


def to_silver(bronze: DataFrame, feed: sc.Feed, run: RunContext) -> DataFrame:
    return with_audit(SILVER[feed.name](bronze), run)


def load_feed(spark: SparkSession, lake: Lake, feed: sc.Feed, run: RunContext, start: date, end: date) -> bool:
    """One feed through bronze and silver; answers False when the range holds no rows."""
    bronze = to_bronze(read_landing(spark, feed, lake.landing(), start, end), feed, run)
    if bronze.isEmpty():
        return False
    path = lake.bronze(feed.name)
    write_replace(bronze, path, feed.date_column, "FILE_NAME")
    # the batch's dates are in bronze's manifest, and its files hold one date each: the landing files are read only once
    loaded = of_dates(read_layer(spark, path, run_date=run.run_date_id), feed.date_column, newest_values(spark, path))
    write_replace(to_silver(loaded, feed, run), lake.silver(feed.name), feed.date_column, "FILE_NAME", dealt=True)
    return True


def pdo_loading(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.PDO_LOADING, run, start, end)


def sap_loading(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.SAP_LOADING, run, start, end)


def dodo_orders(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.DODO_ORDERS, run, start, end)


def codo_stock(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.CODO_STOCK, run, start, end)


def codo_meter(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.CODO_METER, run, start, end)


def codo_trucks(spark, lake, run, start, end):
    return load_feed(spark, lake, sc.CODO_TRUCKS, run, start, end)


def state_mapping(spark: SparkSession, lake: Lake, run: RunContext, file: str = "list_of_local_governments.csv") -> None:
    """State list to bronze and silver; both are replaced whole."""
    raw = with_lineage(spark.read.option("header", True).csv(lake.landing(f"states/{file}")))
    bronze = fix_unnamed(normalize_headers(fix_unnamed(raw, {"_c3": None})), {})
    write_full(with_audit(bronze, run), lake.bronze("state"))
    loaded = read_layer(spark, lake.bronze("state"), run_date=run.run_date_id)
    write_full(with_audit(clean_states(loaded), run), lake.silver("state"))


def book_stock(
    spark: SparkSession, lake: Lake, run: RunContext, start: date, end: date,
    depots: list[str] = sc.BOOK_STOCK_DEPOTS,
) -> bool:
    """Per-depot daily files to per-depot bronze, then all depots to one silver table."""
    days = day_range(start, end)
    for depot in depots:
        df = read_dated_headers(
            spark, lake.landing("book_stock_of_products"), days, f"{depot}_*.csv", sc.BOOK_STOCK_STEMS,
            first="S/N", date_stem="OPENING_PMS_BALANCE",
        )
        if df is not None:
            write_replace(with_audit(df, run), lake.bronze(f"book_stock_of_products/{depot}"), "BOOK_STOCK_DATE", "FILE_NAME")
    tables = {d: lake.bronze(f"book_stock_of_products/{d}") for d in depots}
    merged = read_tagged(spark, tables, "STATION", run_date=run.run_date_id)
    if merged is None or merged.isEmpty():
        return False
    merged = clean_quantities(merged, sc.BOOK_STOCK_STEMS, sentinel=None)
    silver = apply_contract(merged, [("S/N", "SERIAL_NO"), *sc.BOOK_STOCK_SILVER[1:]])
    write_replace(with_audit(silver, run), lake.silver("book_stock_of_products"), "BOOK_STOCK_DATE", "FILE_NAME")
    return True
