"""Joins, aggregates, windows, ordering and the gold feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast import schemas as sc
from stationcast.operators import aggregates as ag
from stationcast.operators import codo
from stationcast.operators import deliveries as dl
from stationcast.operators import ordering as od
from stationcast.operators import sap_dodo as sd
from stationcast.plans import adhoc

from . import views as v
from .feeds_and_shape import dodo
from .registry import check
from .scratch import fresh
from .views import AUDIT_SQL, RUN, ctes


def _round(df, *cols, digits=2):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- delivery windows ----------------------------------------------------------

_LAG = """lead(DELIVERY_DATE) OVER (PARTITION BY STATION, MATERIAL ORDER BY DELIVERY_DATE, RECORD_ID)"""
_SPANS = f"""v_next AS (SELECT *, {_LAG} AS NXT FROM v_deliveries),
v_days AS (SELECT RECORD_ID, STATION, MATERIAL, QUANTITY, STATUS, DELIVERY_DATE, DATE_CREATED,
  coalesce(NXT, DELIVERY_DATE) AS DATE_LAG, CAST(NXT - DELIVERY_DATE AS INTEGER) AS NEXT_DELIVERY_DAYS,
  CAST(unnest(generate_series(DELIVERY_DATE, coalesce(NXT, DELIVERY_DATE), INTERVAL 1 DAY)) AS DATE) AS SALES_DATE
  FROM v_next)"""

check("win_next_delivery", f"{ctes('v_deliveries')} SELECT RECORD_ID, STATION, MATERIAL, DELIVERY_DATE, {_LAG} AS DATE_LAG FROM v_deliveries")(
    lambda spark, sf: dl.next_delivery(v.deliveries(spark, sf)).select("RECORD_ID", "STATION", "MATERIAL", "DELIVERY_DATE", "DATE_LAG")
)
check("win_gap_days", f"{ctes('v_deliveries')}, {_SPANS} SELECT RECORD_ID, CAST(NXT - DELIVERY_DATE AS INTEGER) AS NEXT_DELIVERY_DAYS FROM v_next")(
    lambda spark, sf: dl.gap_days(dl.next_delivery(v.deliveries(spark, sf))).select("RECORD_ID", "NEXT_DELIVERY_DAYS")
)
check("win_lag_fallback", f"{ctes('v_deliveries')}, {_SPANS} SELECT RECORD_ID, coalesce(NXT, DELIVERY_DATE) AS DATE_LAG FROM v_next")(
    lambda spark, sf: dl.window_end(dl.next_delivery(v.deliveries(spark, sf))).select("RECORD_ID", "DATE_LAG")
)
check("gen_explode_dates", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, CAST(unnest(generate_series(DISPATCH_DATE, DELIVERY_DATE, INTERVAL 1 DAY)) AS DATE) AS DAY FROM v_sap WHERE DELIVERY_DATE IS NOT NULL""")(
    lambda spark, sf: dl.explode_days(v.sap(spark, sf), "DISPATCH_DATE", "DELIVERY_DATE", name="DAY").select("DISPATCH_NUMBER", "DAY")
)
check("feat_sales_days", f"{ctes('v_deliveries')}, {_SPANS} SELECT RECORD_ID, STATION, MATERIAL, QUANTITY, DELIVERY_DATE, DATE_LAG, NEXT_DELIVERY_DAYS, SALES_DATE FROM v_days")(
    lambda spark, sf: dl.sales_days(v.deliveries(spark, sf)).select(
        "RECORD_ID", "STATION", "MATERIAL", "QUANTITY", "DELIVERY_DATE", "DATE_LAG", "NEXT_DELIVERY_DAYS", "SALES_DATE")
)


def _window_profile(spark, sf):
    return dl.sales_in_window(v.deliveries(spark, sf), v.meter(spark, sf)).groupBy("DELIVERY_ID", "DELIVERY_DATE").agg(
        F.count("*").alias("n"), F.sum("VOLUME").alias("volume"))


check("jn_delivery_interval", f"""{ctes('v_deliveries', 'v_meter')}, v_next AS (SELECT *, {_LAG} AS NXT FROM v_deliveries)
SELECT d.RECORD_ID AS DELIVERY_ID, d.DELIVERY_DATE, count(*) AS n, sum(m.VOLUME) AS volume FROM v_next d JOIN v_meter m
ON m.STATION = d.STATION AND m.PRODUCT = d.MATERIAL AND m.SALES_DATE BETWEEN d.DELIVERY_DATE AND coalesce(d.NXT, d.DELIVERY_DATE)
GROUP BY 1, 2""")(_window_profile)

# ---- joins -----------------------------------------------------------------------

_TANKS = """v_tank AS (SELECT STATION, TANK_DESCRIPTION, max(DIP_READING) AS MAX_DEEP_READING FROM v_stock GROUP BY 1, 2),
v_cap AS (SELECT STATION, CAST(sum(MAX_DEEP_READING) AS BIGINT) AS TOTAL_STATION_CAPACITY FROM v_tank GROUP BY 1),
v_ntank AS (SELECT STATION, count(DISTINCT TANK_DESCRIPTION) AS TOTAL_NUMBER_OF_TANKS FROM v_stock GROUP BY 1)"""

check("jn_inner_using_1", f"{ctes('v_stock')}, {_TANKS} SELECT * FROM v_ntank JOIN v_cap USING (STATION)")(
    lambda spark, sf: ag.tanks_join_capacity(ag.tank_count(v.stock(spark, sf)), ag.capacity(ag.tank_max(v.stock(spark, sf))))
)
_STATION_TANKS = f"{ctes('v_stock')}, {_TANKS} SELECT * FROM v_ntank JOIN v_cap USING (STATION) JOIN v_tank USING (STATION)"


@check("jn_inner_using_1n", _STATION_TANKS)
def _(spark, sf):
    per_tank = ag.tank_max(v.stock(spark, sf))
    return ag.with_tank_max(ag.tanks_join_capacity(ag.tank_count(v.stock(spark, sf)), ag.capacity(per_tank)), per_tank)


check("feat_station_tanks", _STATION_TANKS)(lambda spark, sf: ag.station_tanks(v.stock(spark, sf)))

_LATEST = """v_last AS (SELECT STATION, MATERIAL, max(DELIVERY_DATE) AS DELIVERY_DATE FROM v_deliveries GROUP BY 1, 2),
v_cur AS (SELECT d.* FROM v_deliveries d JOIN v_last USING (STATION, MATERIAL, DELIVERY_DATE))"""
check("jn_latest_row", f"{ctes('v_deliveries')}, {_LATEST} SELECT RECORD_ID, STATION, MATERIAL, DELIVERY_DATE, QUANTITY FROM v_cur")(
    lambda spark, sf: dl.latest_rows(v.deliveries(spark, sf)).select("RECORD_ID", "STATION", "MATERIAL", "DELIVERY_DATE", "QUANTITY")
)
check("agg_latest_delivery", f"{ctes('v_deliveries')}, {_LATEST} SELECT * FROM v_last")(
    lambda spark, sf: dl.latest_delivery(v.deliveries(spark, sf))
)
_AFTER = f"""{ctes('v_deliveries', 'v_meter')}, {_LATEST}, v_after AS (SELECT c.STATION, c.MATERIAL, c.DELIVERY_DATE, c.QUANTITY, m.SALES_DATE, m.TYPE, m.VOLUME
FROM v_cur c JOIN v_meter m ON m.STATION = c.STATION AND m.PRODUCT = c.MATERIAL WHERE m.SALES_DATE > c.DELIVERY_DATE AND m.TYPE = 'Sales')"""
check("jn_inner_equi_plus_range", f"{_AFTER} SELECT * FROM v_after")(
    lambda spark, sf: codo.sales_since_latest(v.deliveries(spark, sf), v.meter(spark, sf))
)
check("flt_after_delivery_sales", f"{_AFTER} SELECT STATION, MATERIAL, SALES_DATE, VOLUME FROM v_after")(
    lambda spark, sf: codo.sales_after(codo.sales_since_latest(v.deliveries(spark, sf), v.meter(spark, sf))).select("STATION", "MATERIAL", "SALES_DATE", "VOLUME")
)
_SOLD = """SELECT STATION, MATERIAL, DELIVERY_DATE AS CURRENT_DELIVERY_DATE, QUANTITY AS CURRENT_DELIVERED_QUANTITY,
sum(VOLUME) AS TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE FROM v_after GROUP BY 1, 2, 3, 4"""
check("agg_sold_since_delivery", f"{_AFTER} {_SOLD}")(
    lambda spark, sf: codo.sold_since(codo.sales_since_latest(v.deliveries(spark, sf), v.meter(spark, sf)))
)
check("feat_scarcity", f"{_AFTER} {_SOLD}")(
    lambda spark, sf: codo.scarcity(v.deliveries(spark, sf), v.meter(spark, sf))
)
_COUNTS = """v_counts AS (SELECT STATION, MATERIAL, DELIVERY_DATE, QUANTITY, count(QUANTITY) AS COUNT_OF_NEW_ORDERS FROM v_deliveries GROUP BY 1, 2, 3, 4)"""
check("agg_order_counts", f"{ctes('v_deliveries')}, {_COUNTS} SELECT * FROM v_counts")(
    lambda spark, sf: dl.order_counts(v.deliveries(spark, sf))
)
_ORDERS = f"""{_AFTER}, {_COUNTS}, v_sold AS ({_SOLD}), v_orders AS (SELECT * FROM v_sold FULL JOIN v_counts USING (STATION, MATERIAL))"""
check("jn_outer_using_2", f"{_ORDERS} SELECT * FROM v_orders")(
    lambda spark, sf: codo.scarcity_with_orders(codo.scarcity(v.deliveries(spark, sf), v.meter(spark, sf)), dl.order_counts(v.deliveries(spark, sf)))
)

_RAW = f"""{ctes('v_deliveries', 'v_stock', 'v_meter')}, {_SPANS},
v_raw AS (SELECT STATION, PRODUCT, SALES_DATE, MATERIAL, QUANTITY, d.STATUS AS TRUCK_DELIVERY_STATUS, DELIVERY_DATE,
  d.DATE_CREATED AS TRUCK_DELIVERY_DATE_CREATED, DATE_LAG, NEXT_DELIVERY_DAYS, TANK_DESCRIPTION, DIP_READING,
  s.STATUS AS STOCK_VOLUME_STATUS, s.DATE_CREATED AS STOCK_VOLUME_DATE_CREATED, METER_DESCRIPTION, PREVIOUS_READING,
  CURRENT_READING, VOLUME, TYPE, UNIT_PRICE, SALES_VALUE, DEALER_COMMISSION, DEALER_COMMISSION_AMOUNT,
  m.STATUS AS METER_READING_STATUS, m.DATE_CREATED AS METER_READING_DATE_CREATED
  FROM (SELECT *, MATERIAL AS PRODUCT FROM v_days) d FULL JOIN v_stock s USING (STATION, PRODUCT, SALES_DATE)
  FULL JOIN v_meter m USING (STATION, PRODUCT, SALES_DATE))"""
check("jn_outer_using_3_chain", f"{_RAW} SELECT STATION, PRODUCT, SALES_DATE, MATERIAL, TANK_DESCRIPTION, DIP_READING, METER_DESCRIPTION, VOLUME FROM v_raw")(
    lambda spark, sf: codo.combine_codo(dl.sales_days(v.deliveries(spark, sf)), v.stock(spark, sf), v.meter(spark, sf)).select(
        "STATION", "PRODUCT", "SALES_DATE", "MATERIAL", "TANK_DESCRIPTION", "DIP_READING", "METER_DESCRIPTION", "VOLUME")
)
_MONTHS = """CAST(strftime(SALES_DATE, '%Y%m') AS INTEGER) AS SALES_MONTH, CAST(strftime(DELIVERY_DATE, '%Y%m') AS INTEGER) AS DELIVERY_MONTH"""


def codo_raw(spark, sf):
    return codo.codo_raw(v.deliveries(spark, sf), v.stock(spark, sf), v.meter(spark, sf), RUN)


def daily_product(spark, sf):
    return codo.daily_station_product(v.deliveries(spark, sf), v.stock(spark, sf), v.meter(spark, sf))


check("feat_codo_raw", f"{_RAW} SELECT *, {_MONTHS}, {AUDIT_SQL} FROM v_raw")(codo_raw)
_DAILY_PRODUCT = """SELECT STATION, PRODUCT, SALES_DATE, QUANTITY, NEXT_DELIVERY_DAYS, sum(VOLUME) AS TOTAL_VOLUME_SOLD,
round(avg(VOLUME), 2) AS AVG_VOLUME_SOLD_PER_DAY FROM v_raw GROUP BY 1, 2, 3, 4, 5"""
check("agg_daily_station_product", f"{_RAW} {_DAILY_PRODUCT}")(lambda spark, sf: daily_product(spark, sf))

check("jn_inner_record_id", f"""{ctes('v_meter', 'v_stock')} SELECT m.RECORD_ID AS record_id, METER_DESCRIPTION AS meter_description, TANK_DESCRIPTION AS tank_description, VOLUME AS volume, DIP_READING AS dip_reading
FROM v_meter m JOIN v_stock s ON m.RECORD_ID = s.RECORD_ID""")(
    lambda spark, sf: (lambda m, s: adhoc.meter_stock_by_record(m, s).select(
        m["record_id"], "meter_description", "tank_description", "volume", "dip_reading"))(
        v.meter(spark, sf).toDF(*[c.lower() for c in sc.METER_COLUMNS]),
        v.stock(spark, sf).select("RECORD_ID", "TANK_DESCRIPTION", "DIP_READING").toDF("record_id", "tank_description", "dip_reading"))
)
check("jn_inner_document_id", f"""{ctes('v_meter', 'v_sap')} SELECT m.RECORD_ID AS record_id, METER_DESCRIPTION AS meter_description, DISPATCH_NUMBER AS dispatch_number
FROM v_meter m JOIN v_sap s ON CAST(m.RECORD_ID AS VARCHAR) = s.SALES_DOCUMENT""")(
    lambda spark, sf: adhoc.meter_sap_by_document(
        v.meter(spark, sf).select(F.col("RECORD_ID").cast("string").alias("rid"), F.col("RECORD_ID").alias("n"), "METER_DESCRIPTION").toDF("record_id", "n", "meter_description"),
        v.sap(spark, sf).select("SALES_DOCUMENT", "DISPATCH_NUMBER").toDF("sales_document", "dispatch_number"),
    ).select(F.col("n").alias("record_id"), "meter_description", "dispatch_number")
)


def _low(df):
    return df.toDF(*[c.lower() for c in df.columns])


def _dealer_trucks(spark, sf):
    c = v.table(spark, sf, "customer")
    o = v.table(spark, sf, "orders")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.upper(v._dealer_name()).alias("station"), F.lit(1).alias("quantity"))


# Counts and sums over the pairs, each side aggregated before the join.
check("jn_inner_ci", f"""{ctes('v_dodo', 'v_sap')}, a AS (SELECT lower(CUSTOMER_NAME) AS k, count(*) AS n, sum(CAST(QUANTITY_SOLD AS DECIMAL(18,2))) AS q FROM v_dodo GROUP BY 1),
b AS (SELECT lower(DELIVERY_STATION) AS k, count(*) AS n, sum(QUANTITY_ORDERED) AS q FROM v_sap GROUP BY 1),
c AS (SELECT lower('ULTRA ' || CASE WHEN c_nationkey % 2 = 0 THEN 'MEGA ' ELSE 'MINI ' END || 'ST''' || c_nationkey) AS k, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT a.k AS station_name, a.n * b.n * c.n AS PAIRS, CAST(a.q * b.n * c.n AS DOUBLE) AS quantity_sold, CAST(b.q * a.n * c.n AS DOUBLE) AS quantity_ordered, CAST(c.n * a.n * b.n AS BIGINT) AS delivered
FROM a JOIN b USING (k) JOIN c USING (k)""")(
    lambda spark, sf: adhoc.name_matches(
        _low(dodo(spark, sf).select("CUSTOMER_NAME", F.col("QUANTITY_SOLD").cast("decimal(18,2)").alias("QUANTITY_SOLD"))),
        _low(v.sap(spark, sf).select("DELIVERY_STATION", "QUANTITY_ORDERED")), _dealer_trucks(spark, sf),
    ).withColumns({"quantity_sold": F.col("quantity_sold").cast("double")})
)
check("jn_inner_station_nm", f"""{ctes('v_meter', 'v_stock')} SELECT m.STATION AS station, count(*) AS PAIRS, sum(VOLUME) AS volume, CAST(sum(DIP_READING) AS BIGINT) AS dip_reading
FROM v_meter m JOIN v_stock s ON m.STATION = s.STATION GROUP BY 1""")(
    lambda spark, sf: adhoc.station_matches(
        _low(v.meter(spark, sf)), _low(v.stock(spark, sf)), {"volume": F.col("volume")}, {"dip_reading": F.col("dip_reading")})
)
check("jn_truck_stock_station", f"""{ctes('v_deliveries', 'v_stock')} SELECT m.STATION AS station, count(*) AS PAIRS, count(*) AS deliveries, CAST(sum(DIP_READING) AS BIGINT) AS dip_reading
FROM v_deliveries m JOIN v_stock s ON m.STATION = s.STATION GROUP BY 1""")(
    lambda spark, sf: adhoc.station_matches(
        _low(v.deliveries(spark, sf)), _low(v.stock(spark, sf)), {"deliveries": F.lit(1)}, {"dip_reading": F.col("dip_reading")})
)
check("flt_product_station", f"""{ctes('v_meter', 'v_stock')} SELECT m.STATION AS station, METER_DESCRIPTION AS meter_description, TANK_DESCRIPTION AS tank_description, count(*) AS PAIRS, sum(VOLUME) AS volume, CAST(sum(DIP_READING) AS BIGINT) AS dip_reading
FROM v_meter m JOIN v_stock s ON m.STATION = s.STATION WHERE s.PRODUCT = '1-URGENT' AND m.PRODUCT = '1-URGENT' AND s.STATION = 'ST_7' GROUP BY 1, 2, 3""")(
    lambda spark, sf: adhoc.product_station(_low(v.meter(spark, sf)), _low(v.stock(spark, sf)), "1-URGENT", "ST_7")
)

# ---- stock and meter aggregates -----------------------------------------------------

check("agg_tank_max_dip", f"{ctes('v_stock')}, {_TANKS} SELECT * FROM v_tank")(lambda spark, sf: ag.tank_max(v.stock(spark, sf)))
check("agg_station_capacity", f"{ctes('v_stock')}, {_TANKS} SELECT * FROM v_cap")(lambda spark, sf: ag.capacity(ag.tank_max(v.stock(spark, sf))))
check("agg_distinct_tanks", f"{ctes('v_stock')}, {_TANKS} SELECT * FROM v_ntank")(lambda spark, sf: ag.tank_count(v.stock(spark, sf)))
_DAILY = """v_daily AS (SELECT STATION, METER_DESCRIPTION, TYPE, SALES_DATE, round(sum(SALES_VALUE), 2) AS TOTAL_DAILY_SALES_VALUE,
sum(VOLUME) AS TOTAL_DAILY_VOLUME_PRODUCT_SOLD FROM v_meter GROUP BY 1, 2, 3, 4)"""
check("agg_daily_sales", f"{ctes('v_meter')}, {_DAILY} SELECT * FROM v_daily")(
    lambda spark, sf: _round(ag.daily_sales(v.meter(spark, sf)), "TOTAL_DAILY_SALES_VALUE")
)
_PROFILE = """v_profile AS (SELECT STATION, METER_DESCRIPTION, PRODUCT, max(VOLUME) AS MAX_VOLUME_PRODUCT_SOLD, median(VOLUME) AS MEDIAN_VOLUME_PRODUCT_SOLD,
min(VOLUME) AS MIN_VOLUME_PRODUCT_SOLD, round(sum(SALES_VALUE), 2) AS TOTAL_SALES_VALUE, max(SALES_VALUE) AS MAX_SALES_VALUE,
round(median(SALES_VALUE), 3) AS MEDIAN_SALES_VALUE, min(SALES_VALUE) AS MIN_SALES_VALUE, max(CURRENT_READING) AS MAX_CURRENT_READING,
median(CURRENT_READING) AS MEDIAN_CURRENT_READING, min(CURRENT_READING) AS MIN_CURRENT_READING, max(PREVIOUS_READING) AS MAX_PREVIOUS_READING,
median(PREVIOUS_READING) AS MEDIAN_PREVIOUS_READING, min(PREVIOUS_READING) AS MIN_PREVIOUS_READING FROM v_meter GROUP BY 1, 2, 3)"""


def _profile(spark, sf):
    return _round(_round(ag.meter_profile(v.meter(spark, sf)), "TOTAL_SALES_VALUE"), "MEDIAN_SALES_VALUE", digits=3)


check("agg_meter_profile", f"{ctes('v_meter')}, {_PROFILE} SELECT * FROM v_profile")(_profile)
check("jn_outer_using_2_meter", f"{ctes('v_meter')}, {_DAILY}, {_PROFILE} SELECT * FROM v_daily FULL JOIN v_profile USING (STATION, METER_DESCRIPTION)")(
    lambda spark, sf: ag.daily_with_profile(
        _round(ag.daily_sales(v.meter(spark, sf)), "TOTAL_DAILY_SALES_VALUE"), _profile(spark, sf))
)
check("agg_counts", f"{ctes('v_sap')} SELECT count(*) AS n FROM v_sap WHERE trim(lower(DELIVERY_STATION)) LIKE '% mega %' OR trim(lower(DISTRIBUTION_CHANNEL)) = 'affiliate station'")(
    lambda spark, sf: sd.affiliate_or_mega(v.sap(spark, sf)).agg(F.count("*").alias("n"))
)

# ---- the wide station table ----------------------------------------------------------

_PARTS = f"""{_ORDERS.replace(ctes('v_deliveries', 'v_meter'), ctes('v_deliveries', 'v_meter', 'v_stock'))},
{_TANKS}, v_tanks AS (SELECT * FROM v_ntank JOIN v_cap USING (STATION) JOIN v_tank USING (STATION)),
v_daily AS (SELECT STATION, METER_DESCRIPTION, TYPE, SALES_DATE, sum(VOLUME) AS V FROM v_meter GROUP BY 1, 2, 3, 4),
v_prof AS (SELECT STATION, METER_DESCRIPTION, PRODUCT, max(VOLUME) AS TOP FROM v_meter GROUP BY 1, 2, 3),
v_meters AS (SELECT * FROM v_daily FULL JOIN v_prof USING (STATION, METER_DESCRIPTION)),
t AS (SELECT STATION, count(*) AS nt, sum(MAX_DEEP_READING) AS dips, any_value(TOTAL_STATION_CAPACITY) AS cap, any_value(TOTAL_NUMBER_OF_TANKS) AS tanks FROM v_tanks GROUP BY 1)"""


def _factors(spark, sf):
    """The parts; the summaries below read no median, so the cheap ones are asked for and pruned."""
    return codo.codo_factors(v.deliveries(spark, sf), v.stock(spark, sf), v.meter(spark, sf), exact=False)


check("feat_codo_agg", f"""{_PARTS}, o AS (SELECT STATION, count(*) AS no, sum(COUNT_OF_NEW_ORDERS) AS c FROM v_orders GROUP BY 1),
m AS (SELECT STATION, count(*) AS nm, sum(V) AS v, min(SALES_DATE) AS d0, max(SALES_DATE) AS d1, max(TOP) AS top FROM v_meters GROUP BY 1)
SELECT STATION, CAST(coalesce(no, 1) * coalesce(nt, 1) * coalesce(nm, 1) AS BIGINT) AS WIDE_ROWS,
CAST(c * coalesce(nt, 1) * coalesce(nm, 1) AS BIGINT) AS COUNT_OF_NEW_ORDERS, CAST(dips * coalesce(no, 1) * coalesce(nm, 1) AS BIGINT) AS MAX_DEEP_READING,
v * coalesce(no, 1) * coalesce(nt, 1) AS TOTAL_DAILY_VOLUME_PRODUCT_SOLD, tanks AS TOTAL_NUMBER_OF_TANKS, cap AS TOTAL_STATION_CAPACITY,
d0 AS FIRST_SALES_DATE, d1 AS LAST_SALES_DATE, top AS MAX_VOLUME_PRODUCT_SOLD
FROM o FULL JOIN t USING (STATION) FULL JOIN m USING (STATION)""")(
    lambda spark, sf: codo.station_wide_summary(_factors(spark, sf))
)
check("feat_codo_agg_orders", f"{_ORDERS} SELECT * FROM v_orders")(lambda spark, sf: _factors(spark, sf).orders)
_VOLUME = f"""{_PARTS}, o AS (SELECT STATION, MATERIAL, CURRENT_DELIVERY_DATE, QUANTITY, count(*) AS no, max(TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE) AS sold FROM v_orders GROUP BY 1, 2, 3, 4),
d AS (SELECT STATION, SALES_DATE, sum(V) AS v FROM v_meters GROUP BY 1, 2), s AS (SELECT STATION, count(SALES_DATE) AS n, sum(v) AS v, max(v) AS peak FROM d GROUP BY 1)
SELECT STATION, MATERIAL, CURRENT_DELIVERY_DATE, cap AS TOTAL_STATION_CAPACITY, QUANTITY, n AS SALES_DAYS, v * coalesce(no, 1) * coalesce(nt, 1) AS TOTAL_VOLUME_SOLD,
peak * coalesce(no, 1) * coalesce(nt, 1) AS PEAK_DAY_VOLUME_SOLD, sold AS TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY
FROM o FULL JOIN t USING (STATION) FULL JOIN s USING (STATION)"""
VOLUME_SQL = _VOLUME
check("agg_station_volume", _VOLUME)(
    lambda spark, sf: codo.station_volume_by_order(_factors(spark, sf))
)
check("agg_station_volume_days", f"""{_PARTS}, o AS (SELECT STATION, count(*) AS no, count(DISTINCT (MATERIAL, CURRENT_DELIVERY_DATE, QUANTITY)) AS groups, max(TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE) AS sold FROM v_orders GROUP BY 1),
d AS (SELECT STATION, SALES_DATE, sum(V) AS v FROM v_meters GROUP BY 1, 2)
SELECT STATION, SALES_DATE, cap AS TOTAL_STATION_CAPACITY, groups AS ORDER_GROUPS, v * coalesce(no, 1) * coalesce(nt, 1) AS TOTAL_VOLUME_SOLD, v AS VOLUME_PER_ORDER_AND_TANK,
sold AS TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY FROM d FULL JOIN t USING (STATION) FULL JOIN o USING (STATION)""")(
    lambda spark, sf: codo.station_volume_by_day(_factors(spark, sf))
)
VOLUME_MAX_SQL = f"""{_PARTS}, o AS (SELECT DISTINCT STATION, MATERIAL, DELIVERY_DATE, QUANTITY FROM v_orders),
s AS (SELECT STATION, count(DISTINCT SALES_DATE) AS n, max(V) AS top FROM v_meters GROUP BY 1)
SELECT STATION, MATERIAL, DELIVERY_DATE, cap AS TOTAL_STATION_CAPACITY, QUANTITY, n AS SALES_DAYS, top AS TOTAL_VOLUME_SOLD FROM o FULL JOIN t USING (STATION) FULL JOIN s USING (STATION)"""
check("agg_station_volume_max", VOLUME_MAX_SQL)(
    lambda spark, sf: codo.station_volume_max_by_order(_factors(spark, sf))
)
check("jn_outer_station_nm", f"""{_PARTS}, o AS (SELECT STATION, count(*) AS n, sum(COUNT_OF_NEW_ORDERS) AS c FROM v_orders GROUP BY 1)
SELECT STATION, CAST(n AS BIGINT) AS ORDER_ROWS, CAST(c AS BIGINT) AS NEW_ORDERS, MAX_DEEP_READING, TANK_DESCRIPTION FROM o FULL JOIN v_tanks USING (STATION)""")(
    lambda spark, sf: (lambda f: codo.station_wide(
        f.orders.groupBy("STATION").agg(F.count("*").alias("ORDER_ROWS"), F.sum("COUNT_OF_NEW_ORDERS").alias("NEW_ORDERS")),
        f.tanks.select("STATION", "MAX_DEEP_READING", "TANK_DESCRIPTION")))(_factors(spark, sf))
)

# ---- loading report and dealer orders -------------------------------------------------

_WANTED = """v_want AS (SELECT DISTINCT * FROM v_sap WHERE trim(lower(DISTRIBUTION_CHANNEL)) = 'affiliate station' OR trim(lower(DELIVERY_STATION)) LIKE '% mega %'),
v_join AS (SELECT DISTINCT s.*, d.* EXCLUDE (RRR_NUMBER), d.RRR_NUMBER AS DODO_RRR_NUMBER FROM v_want s FULL JOIN v_dodo d ON trim(s.SALES_QUOTATION) = trim(d.SAP_QUOTATION_NUMBER))"""
_METRICS = f"""{ctes('v_sap', 'v_dodo')}, {_WANTED}, v_metric AS (SELECT *,
QUANTITY_ORDERED * 0.95::DOUBLE AS QUANTITY_ORDERED_TEMP_TOLERANCE_MIN, QUANTITY_ORDERED * 1.05::DOUBLE AS QUANTITY_ORDERED_TEMP_TOLERANCE_MAX,
CAST(DELIVERY_DATE - SALES_DATE AS INTEGER) AS DELIVERY_DAYS, CAST(DISPATCH_DATE - SALES_DATE AS INTEGER) AS ORDER_PROCESSING_DAYS,
strftime(DELIVERY_DATE, '%a') AS DELIVERY_DATE_DAY_OF_WEEK, strftime(DISPATCH_DATE, '%a') AS DISPATCH_DATE_DAY_OF_WEEK,
strftime(COMPLETED_ON, '%a') AS COMPLETED_ON_DATE_DAY_OF_WEEK, strftime(SALES_DATE, '%a') AS SALES_DATE_DAY_OF_WEEK FROM v_join),
v_flag AS (SELECT *, CAST(CASE WHEN QUANTITY_DELIVERED >= QUANTITY_ORDERED_TEMP_TOLERANCE_MIN AND QUANTITY_DELIVERED <= QUANTITY_ORDERED_TEMP_TOLERANCE_MAX THEN 1 ELSE 0 END AS INTEGER) AS IS_QUANTITY_DELIVERED_WITHIN_TEMP_THRESHOLD,
CAST(CASE WHEN DELIVERY_DAYS > 5 THEN 1 ELSE 0 END AS INTEGER) AS DELIVERY_IS_DELAYED,
CAST(CASE WHEN DISPATCH_DATE IS NOT NULL AND DELIVERY_DATE IS NULL AND COMPLETED_ON IS NULL THEN 1 ELSE 0 END AS INTEGER) AS IS_PRODUCT_IN_TRANSIST FROM v_metric)"""


def _joined(spark, sf):
    return sd.sap_full_dodo(sd.affiliate_or_mega(v.sap(spark, sf)), dodo(spark, sf))


check("jn_outer_trim_key", f"{ctes('v_sap', 'v_dodo')}, {_WANTED} SELECT SALES_QUOTATION, DISPATCH_NUMBER, RRR_NUMBER, QUANTITY_ORDERED, SAP_QUOTATION_NUMBER, DODO_RRR_NUMBER, QUANTITY, SALES_DATE FROM v_join")(
    lambda spark, sf: _joined(spark, sf).select("SALES_QUOTATION", "DISPATCH_NUMBER", "RRR_NUMBER", "QUANTITY_ORDERED", "SAP_QUOTATION_NUMBER", "DODO_RRR_NUMBER", "QUANTITY", "SALES_DATE")
)
check("set_dedup_rows", f"{ctes('v_sap')} SELECT DISTINCT SALES_QUOTATION, WAYBILL_NUMBER, DELIVERY_STATION FROM v_sap")(
    lambda spark, sf: od.dedup(v.sap(spark, sf).select("SALES_QUOTATION", "WAYBILL_NUMBER", "DELIVERY_STATION"))
)
_KEY = "DISPATCH_NUMBER, RRR_NUMBER, SAP_PAYMENT_NUMBER"


def _metric(name, cols, step):
    keys = _KEY.split(", ")
    check(name, f"{_METRICS} SELECT {_KEY}, {', '.join(cols)} FROM v_flag")(
        lambda spark, sf: step(_joined(spark, sf)).select(*keys, *cols)
    )


_metric("feat_tolerance_band", ["QUANTITY_ORDERED_TEMP_TOLERANCE_MIN", "QUANTITY_ORDERED_TEMP_TOLERANCE_MAX"], sd.tolerance_band)
_metric("feat_within_band", ["IS_QUANTITY_DELIVERED_WITHIN_TEMP_THRESHOLD"], lambda df: sd.within_band(sd.tolerance_band(df)))
_metric("feat_delivery_days", ["DELIVERY_DAYS", "ORDER_PROCESSING_DAYS"], sd.lead_times)
_metric("feat_is_delayed", ["DELIVERY_IS_DELAYED"], lambda df: sd.is_delayed(sd.lead_times(df)))
_metric("feat_in_transit", ["IS_PRODUCT_IN_TRANSIST"], sd.in_transit)
_metric("feat_day_of_week", list(sd.WEEKDAY_COLUMNS.values()), sd.weekdays)


def sap_dodo_features(spark, sf):
    return sd.sap_dodo(v.sap(spark, sf), dodo(spark, sf), RUN)


check("feat_sap_dodo", f"{_METRICS} SELECT {', '.join(sc.SAP_DODO)}, {AUDIT_SQL} FROM v_flag")(sap_dodo_features)
SAP_DODO_SQL = _METRICS
RAW_SQL = _RAW
DAILY_PRODUCT_SQL = _DAILY_PRODUCT

# ---- ordering ---------------------------------------------------------------------------

check("srt_desc_metric", f"{ctes('v_stock')}, {_TANKS} SELECT *, CAST(row_number() OVER (ORDER BY TOTAL_STATION_CAPACITY DESC NULLS LAST, STATION NULLS FIRST) AS BIGINT) AS POSITION FROM v_cap")(
    lambda spark, sf: od.numbered(ag.capacity(ag.tank_max(v.stock(spark, sf))), [("TOTAL_STATION_CAPACITY", False), ("STATION", True)], fresh(spark, "numbered"))
)
check("srt_multi_mixed", f"{ctes('v_deliveries')}, {_COUNTS} SELECT *, CAST(row_number() OVER (ORDER BY STATION NULLS FIRST, DELIVERY_DATE DESC NULLS LAST, MATERIAL NULLS FIRST, QUANTITY NULLS FIRST) AS BIGINT) AS POSITION FROM v_counts")(
    lambda spark, sf: od.numbered(dl.order_counts(v.deliveries(spark, sf)), [("STATION", True), ("DELIVERY_DATE", False), ("MATERIAL", True), ("QUANTITY", True)], fresh(spark, "numbered"))
)
check("srt_topk_oldest", f"{ctes('v_tweets')} SELECT tweet_id, author, tweet_date FROM v_tweets ORDER BY tweet_date, tweet_id LIMIT 100")(
    lambda spark, sf: od.oldest(v.tweets(spark, sf), 100).select("tweet_id", "author", "tweet_date")
)
check("srt_head", f"{ctes('v_tweets')} SELECT tweet_id, author FROM v_tweets ORDER BY tweet_id LIMIT 5")(
    lambda spark, sf: od.head(v.tweets(spark, sf).select("tweet_id", "author"), 5, "tweet_id")
)
