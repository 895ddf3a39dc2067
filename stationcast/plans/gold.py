"""Silver to gold feature tables, written once and published from what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as sc
from ..operators import codo
from ..operators.sap_dodo import sap_dodo
from ..operators.shaping import with_audit
from ..run import RunContext
from ..sources.layers import publish_path, read_layer, write_full
from .lake import Lake

PARTS = ("orders", "tanks", "meters")


def codo_gold(spark: SparkSession, lake: Lake, run: RunContext, start: int, end: int, database: str = "default") -> None:
    """Raw features and the parts of the wide station table, plus the published tables and view.

    ``start`` and ``end`` are run-date ids of the silver layer.
    """
    trucks, stock, meter = (
        read_layer(spark, lake.silver(f.name), start=start, end=end).drop(*sc.AUDIT_COLUMNS, "FILE_NAME")
        for f in (sc.CODO_TRUCKS, sc.CODO_STOCK, sc.CODO_METER)
    )
    write_full(codo.codo_raw(trucks, stock, meter, run), lake.gold("codo_raw_features"), "SALES_DATE")
    publish_path(spark, lake.gold("codo_raw_features"), f"{database}.codo_raw_features")
    daily = with_audit(codo.daily_station_product(trucks, stock, meter), run)
    write_full(daily, lake.gold("codo_daily_station_product"))
    publish_path(spark, lake.gold("codo_daily_station_product"), f"{database}.codo_daily_station_product")

    factors = codo.codo_factors(trucks, stock, meter)
    for part in PARTS:
        path = lake.gold(f"codo_agg_feature_store/{part}")
        write_full(with_audit(getattr(factors, part), run), path)
        publish_path(spark, path, f"{database}.codo_agg_{part}")
    create_wide_view(spark, database)


def create_wide_view(spark: SparkSession, database: str = "default") -> None:
    """The 31-column table as a view over its parts.

    Written as left joins plus the unmatched rows of each part, like the library's outer join, so
    filters on the view reach the scans of the parts.
    """
    names = {p: [c for c in spark.table(f"{database}.codo_agg_{p}").columns if c != "STATION"] for p in PARTS}
    o, t, m = (f"{database}.codo_agg_{p}" for p in PARTS)
    own = {p: [c for c in names[p] if c not in sc.AUDIT_COLUMNS] for p in PARTS}

    def nulls(part: str) -> str:
        return ", ".join(f"NULL AS {c}" for c in own[part])

    def cols(part: str) -> str:
        return ", ".join(own[part])

    def stamp(*sides: str) -> str:
        if len(sides) == 1:
            return ", ".join(f"{sides[0]}.{c} AS {c}" for c in sc.AUDIT_COLUMNS)
        return ", ".join(f"coalesce({', '.join(f'{s}.{c}' for s in sides)}) AS {c}" for c in sc.AUDIT_COLUMNS)

    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.codo_agg_feature_store AS
        WITH ot AS (
            SELECT o.STATION, {cols("orders")}, {cols("tanks")}, {stamp("o", "t")}
            FROM {o} o LEFT JOIN {t} t ON o.STATION = t.STATION
            UNION ALL
            SELECT t.STATION, {nulls("orders")}, {cols("tanks")}, {stamp("t")}
            FROM {t} t LEFT ANTI JOIN (SELECT DISTINCT STATION FROM {o}) k ON t.STATION = k.STATION
        ), wide AS (
            SELECT a.STATION, {cols("orders")}, {cols("tanks")}, {cols("meters")}, {stamp("a", "m")}
            FROM ot a LEFT JOIN {m} m ON a.STATION = m.STATION
            UNION ALL
            SELECT m.STATION, {nulls("orders")}, {nulls("tanks")}, {cols("meters")}, {stamp("m")}
            FROM {m} m LEFT ANTI JOIN
                 (SELECT STATION FROM {o} UNION SELECT STATION FROM {t}) k ON m.STATION = k.STATION
        )
        SELECT {", ".join(sc.CODO_AGG)},
               year(SALES_DATE) * 100 + month(SALES_DATE) AS SALES_MONTH,
               year(DELIVERY_DATE) * 100 + month(DELIVERY_DATE) AS DELIVERY_MONTH,
               {", ".join(sc.AUDIT_COLUMNS)}
        FROM wide
    """)


def load_factors(spark: SparkSession, lake: Lake, run_date: int | None = None) -> codo.StationFactors:
    parts = {
        p: read_layer(spark, lake.gold(f"codo_agg_feature_store/{p}"), run_date=run_date).drop(*sc.AUDIT_COLUMNS)
        for p in PARTS
    }
    return codo.StationFactors(**parts)


def codo_agg_view(spark: SparkSession, lake: Lake, run: RunContext) -> tuple[DataFrame, DataFrame]:
    """The two volume summaries of the run's wide table, one row per order group: sums over its sales days, and the
    largest single figure. ``codo.station_volume`` has every pair of order group and day, for a few stations."""
    f = load_factors(spark, lake, run.run_date_id)
    return codo.station_volume_by_order(f), codo.station_volume_max_by_order(f)


def sap_dodo_gold(spark: SparkSession, lake: Lake, run: RunContext, database: str = "default") -> None:
    sap = read_layer(spark, lake.silver(sc.SAP_LOADING.name))
    dodo = read_layer(spark, lake.silver(sc.DODO_ORDERS.name))
    path = lake.gold("sap_dodo_feature_store")
    write_full(sap_dodo(sap, dodo, run), path, "SALES_DATE")
    publish_path(spark, path, f"{database}.sap_dodo_feature_store")
