"""Landing ranges, lineage, unnamed columns, and the loads and publications that end in a table of their own."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from stationcast import schemas as sc
from stationcast.operators import shaping as sh
from stationcast.plans import forecasts as plan
from stationcast.plans import gold, ingest
from stationcast.plans.lake import Lake
from stationcast.sources import feeds
from stationcast.sources import layers as ly

from . import views as v
from .demand import VOLUME_MAX_SQL, VOLUME_SQL
from .layers_and_streams import through
from .registry import check
from .replays import codo_silver
from .scratch import fresh
from .text_and_forecast import CODO_MERGE, SAP_MERGE, codo_models, sap_models
from .views import AUDIT_SQL, RUN, ctes

#: Landing days of the deliveries by record id; the fourth has no folder, the last is out of range.
_DAYS = ("20240201", "20240202", "20240203", "20240205", "20240206")
_DAY_SQL = f"[{', '.join(repr(d) for d in _DAYS)}][1 + RECORD_ID % 5]"


def _landed(spark, sf):
    """Deliveries of four days, read as the range from the first to the fifth."""
    lake, rows = Lake(fresh(spark, "range")), v.deliveries(spark, sf).select(*sc.TRUCK_COLUMNS)
    text = rows.select(*[F.col(c).cast("string") for c in rows.columns]).toDF(*sc.CODO_TRUCKS.headers)
    number = F.col(sc.CODO_TRUCKS.headers[0]).cast("long")
    for k, day in enumerate(_DAYS):
        text.where(number % 5 == k).write.option("header", True).csv(f"{lake.landing(sc.CODO_TRUCKS.name)}/{day}/{sc.CODO_TRUCKS.file}")
    raw = feeds.read_landing(spark, sc.CODO_TRUCKS, lake.landing(), date(2024, 2, 1), date(2024, 2, 5))
    return sh.normalize_headers(sh.rename(raw, sc.CODO_TRUCKS.renames))


check("src_landing_date_range", f"{ctes('v_deliveries')} SELECT CAST(RECORD_ID AS VARCHAR) AS RECORD_ID, STATION, MATERIAL FROM v_deliveries WHERE {_DAY_SQL} < '20240206'")(
    lambda spark, sf: _landed(spark, sf).select("RECORD_ID", "STATION", "MATERIAL")
)
check("src_file_lineage", f"{ctes('v_deliveries')} SELECT CAST(RECORD_ID AS VARCHAR) AS RECORD_ID, {_DAY_SQL} AS LANDING_DAY, '{sc.CODO_TRUCKS.file}' AS LANDING_FILE FROM v_deliveries WHERE {_DAY_SQL} < '20240206'")(
    lambda spark, sf: _landed(spark, sf).select(
        "RECORD_ID", F.regexp_extract("FILE_NAME", r"/(\d{8})/([^/]+)/[^/]+$", 1).alias("LANDING_DAY"),
        F.regexp_extract("FILE_NAME", r"/(\d{8})/([^/]+)/[^/]+$", 2).alias("LANDING_FILE"))
)


@check("src_unnamed_first_col", "SELECT CAST(c_custkey AS VARCHAR) AS ROW_NO, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    """A file whose first and last headers are blank, as an index column is exported."""
    path, rows = fresh(spark, "unnamed"), v.table(spark, sf, "customer")
    text = rows.select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", F.lit("x").alias("rest"))
    text.toDF(" ", "c_name", "c_mktsegment", "  ").write.option("header", True).csv(path)
    return sh.fix_unnamed(spark.read.option("header", True).csv(path), {"_c0": "ROW_NO", "_c3": None})


#: Columns of the loading report that stand in for those of the other one.
_PDO = dict(zip(sc.PDO_COLUMNS, (
    "TICKET_NUMBER", "DISPATCH_NUMBER", "DISPATCH_DATE", "SALES_DOCUMENT", "REGISTERED_OWNER", "VEHICLE_NUMBER", "DESTINATION", "PRODUCT_TYPE",
    "LOADING_DEPOT_NAME", "LOADING_DATE", "RECEIVING_DEPOT", "BATCH", "CREATED_BY", "QUANTITY_ORDERED", "QUANTITY_LOADED", "TRANSACTION_UOM12",
)))


@check("pipe_pdo_loading", f"""{ctes('v_sap')} SELECT {', '.join(f'{c} AS {n}' if n == 'LOADING_DATE' else f'CAST({c} AS VARCHAR) AS {n}' for n, c in _PDO.items())}, {AUDIT_SQL} FROM v_sap""")
def _(spark, sf):
    rows = v.sap(spark, sf).select(*[F.col(c).alias(n) for n, c in _PDO.items()])
    return through(spark, sc.PDO_LOADING, rows, ingest.pdo_loading).drop("FILE_NAME")


def _published(spark, tables, publish):
    """The given model tables in gold, published to a catalog table."""
    lake, name = Lake(fresh(spark, "models")), f"default.forecast_{uuid.uuid4().hex}"
    for model, rows in tables.items():
        ly.write_full(rows, lake.gold(plan.MODEL_TABLES[model]))
    for _ in range(2):
        publish(spark, lake, RUN, name)
    return spark.table(name)


check("pipe_forecast_sap_publish", f"{SAP_MERGE} SELECT *, {AUDIT_SQL} FROM mrg")(
    lambda spark, sf: _published(spark, dict(zip(("delays", "orders"), sap_models(spark, sf))), plan.publish_sap)
)
check("pipe_forecast_codo_publish", f"{CODO_MERGE} SELECT *, {AUDIT_SQL} FROM fin")(
    lambda spark, sf: _published(spark, dict(zip(("next_delivery", "sales", "quantity"), codo_models(spark, sf))), plan.publish_codo)
)


def _agg_view(spark, sf):
    lake, _ = codo_silver(spark, sf)
    return gold.codo_agg_view(spark, lake, RUN)


check("pipe_codo_agg_view", VOLUME_SQL)(lambda spark, sf: _agg_view(spark, sf)[0])
check("pipe_codo_agg_view_max", VOLUME_MAX_SQL)(lambda spark, sf: _agg_view(spark, sf)[1])
