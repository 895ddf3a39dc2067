"""Layer reads, headers, contracts, filters, scalar functions and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast import schemas as sc
from stationcast.functions import columns as fx
from stationcast.operators import aggregates as ag
from stationcast.operators import cleaning as cl
from stationcast.operators import filters as fl
from stationcast.operators import shaping as sh
from stationcast.sources import documents as docs
from stationcast.sources import layers as ly

from . import views as v
from .registry import check
from .scratch import fresh
from .views import AUDIT_SQL, RUN, ctes


def _runs(df):
    """Meter rows stamped with the day they would have been loaded."""
    return df.withColumn("RUN_DATE_ID", fx.day_key("SALES_DATE"))


_RUN_ID = "CAST(strftime(SALES_DATE, '%Y%m%d') AS INTEGER)"

# ---- sources ---------------------------------------------------------------

_TWO = f"""SELECT RECORD_ID, METER_DESCRIPTION AS NAME, VOLUME AS READING, 'METER' AS STATION_FEED FROM v_meter
UNION ALL SELECT RECORD_ID, TANK_DESCRIPTION, CAST(DIP_READING AS DOUBLE), 'STOCK' FROM v_stock"""


@check("src_tagged_sources", f"{ctes('v_meter', 'v_stock')} {_TWO}")
def _(spark, sf):
    a = v.meter(spark, sf).select("RECORD_ID", F.col("METER_DESCRIPTION").alias("NAME"), F.col("VOLUME").alias("READING"))
    b = v.stock(spark, sf).select("RECORD_ID", F.col("TANK_DESCRIPTION").alias("NAME"), F.col("DIP_READING").cast("double").alias("READING"))
    paths = {name: fresh(spark, name) for name in ("METER", "STOCK", "NOT_WRITTEN_YET")}
    ly.write_full(a, paths["METER"])
    ly.write_full(b, paths["STOCK"])
    return ly.read_tagged(spark, paths, "STATION_FEED")


def _layer(spark, sf, **runs):
    """Meter rows written as a layer of many runs, partitioned like the layers, and read back."""
    path = fresh(spark, "runs")
    ly.write_full(_runs(v.meter(spark, sf)).select("RECORD_ID", "STATION", "VOLUME", "RUN_DATE_ID"), path, "STATION")
    return ly.read_layer(spark, path, **runs).select("RECORD_ID", "STATION", "VOLUME", "RUN_DATE_ID")


@check("src_layer_run_eq", f"""{ctes('v_meter')} SELECT RECORD_ID, STATION, VOLUME, {_RUN_ID} AS RUN_DATE_ID FROM v_meter
WHERE {_RUN_ID} = 19980105""")
def _(spark, sf):
    return _layer(spark, sf, run_date=19980105)


@check("src_layer_run_between", f"""{ctes('v_meter')} SELECT RECORD_ID, STATION, VOLUME, {_RUN_ID} AS RUN_DATE_ID FROM v_meter
WHERE {_RUN_ID} BETWEEN 19980101 AND 19980331""")
def _(spark, sf):
    return _layer(spark, sf, start=19980101, end=19980331)


check("src_layer_run_from", f"{ctes('v_meter')} SELECT RECORD_ID, STATION, VOLUME, {_RUN_ID} AS RUN_DATE_ID FROM v_meter WHERE {_RUN_ID} >= 19980301")(
    lambda spark, sf: _layer(spark, sf, start=19980301)
)
check("src_layer_run_to", f"{ctes('v_meter')} SELECT RECORD_ID, STATION, VOLUME, {_RUN_ID} AS RUN_DATE_ID FROM v_meter WHERE {_RUN_ID} <= 19980301")(
    lambda spark, sf: _layer(spark, sf, end=19980301)
)


check("flt_run_date", f"""{ctes('v_meter')} SELECT STATION, count(*) AS n, sum(VOLUME) AS volume FROM v_meter
WHERE {_RUN_ID} BETWEEN 19970101 AND 19971231 GROUP BY STATION""")(
    lambda spark, sf: fl.by_run_range(_runs(v.meter(spark, sf)), 19970101, 19971231)
    .groupBy("STATION").agg(F.count("*").alias("n"), F.sum("VOLUME").alias("volume"))
)

@check("src_layer_full", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(spark, sf):
    path, columns = fresh(spark, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    for _ in range(2):
        ly.write_full(v.table(spark, sf, "orders").select(*columns), path)
    return ly.read_layer(spark, path)


@check("src_docs_eq", f"""{ctes('v_tweets')} SELECT author, tweet_text, load_date FROM v_tweets WHERE load_date = '2024-01-31'""")
def _(spark, sf):
    return docs.docs_of_day(v.tweets(spark, sf), "2024-01-31", ("tweet_id",)).select("author", "tweet_text", "load_date")


@check("src_docs_range", """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS created_date FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")
def _(spark, sf):
    e = v.table(spark, sf, "events").withColumn("createdAt", F.col("ts").cast("timestamp"))
    return docs.docs_in_range(e, "2024-01-05 00:00:00", "2024-01-12 00:00:00", ("props",)).select(
        "event_id", "user_id", "event_type", "created_date")


@check("src_keyword_topics", f"""{ctes('v_articles')} SELECT _id, CAST(i - 1 AS INTEGER) AS position, keywords[i] AS topic
FROM v_articles, unnest(range(1, len(keywords) + 1)) AS t(i)
UNION ALL SELECT _id, NULL, NULL FROM v_articles WHERE len(keywords) = 0""")
def _(spark, sf):
    return docs.topics(v.articles(spark, sf).select("_id", "keywords"), "keywords")


# ---- projections -----------------------------------------------------------

def _spaced(spark, sf):
    return v.states(spark, sf).toDF("Sno", "State Name", "Local Government Area")


check("prj_headers_upper", f"""{ctes('v_states')} SELECT SNO, STATE AS STATE_NAME, LOCAL_GOVERNMENT_AREA FROM v_states""")(
    lambda spark, sf: sh.normalize_headers(_spaced(spark, sf))
)
check("prj_headers_lower", f"""{ctes('v_states')} SELECT SNO AS sno, STATE AS state_name, LOCAL_GOVERNMENT_AREA AS local_government_area FROM v_states""")(
    lambda spark, sf: sh.normalize_headers(_spaced(spark, sf), "lower")
)
check("prj_headers_strip_dots", f"""{ctes('v_dodo_text')} SELECT SHIPMENT_DOC_NUMBER AS shipment_doc_number, CLEARING_DOC_NUMBER AS clearing_doc_number FROM v_dodo_text""")(
    lambda spark, sf: sh.normalize_headers(
        v.dodo_text(spark, sf).select("SHIPMENT_DOC_NUMBER", "CLEARING_DOC_NUMBER")
        .toDF("Shipment Doc. Number", "Clearing Doc. Number"), "lower", ".")
)
check("prj_rename_map", f"""{ctes('v_dodo_text')} SELECT SHIPMENT_DOC_NUMBER AS Shipment_Doc_Number, CLEARING_DOC_NUMBER AS Clearing_Doc_Number FROM v_dodo_text""")(
    lambda spark, sf: sh.rename(
        v.dodo_text(spark, sf).select("SHIPMENT_DOC_NUMBER", "CLEARING_DOC_NUMBER")
        .toDF("Shipment Doc. Number", "Clearing Doc. Number"), sc.DODO_DOTTED_HEADERS)
)

_DATED = ", ".join(f"s_acctbal + {i} AS {s}" for i, s in enumerate(sc.BOOK_STOCK_STEMS))


@check("prj_dated_headers", f"SELECT s_suppkey AS SN, {_DATED}, '20230105' AS BOOK_STOCK_DATE FROM supplier")
def _(spark, sf):
    dated = v.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("SN"),
        *[(F.col("s_acctbal") + i).alias(f"{s}_05-JANUARY-23") for i, s in enumerate(sc.BOOK_STOCK_STEMS)],
    )
    with_day = sh.date_from_header(dated, "OPENING_PMS_BALANCE", 3, "%d-%B-%y")
    return sh.canonicalize_by_stem(with_day, sc.BOOK_STOCK_STEMS)


_CONTRACT = [("RECORD_ID", "RECORD_ID", "string"), "STATION", ("DIP_READING", "DIP_READING", "int"), ("STATUS", "STOCK_STATUS")]
check("prj_contract", f"""{ctes('v_stock')} SELECT CAST(RECORD_ID AS VARCHAR) AS RECORD_ID, STATION, DIP_READING, STATUS AS STOCK_STATUS FROM v_stock""")(
    lambda spark, sf: sh.apply_contract(v.stock(spark, sf), _CONTRACT)
)


@check("prj_qualified_select", f"""{ctes('v_deliveries', 'v_sap')} SELECT d.RECORD_ID, d.STATUS AS TRUCK_STATUS, s.SHIPMENT_STATUS, s.DELIVERY_DATE AS SAP_DATE, d.DELIVERY_DATE AS TRUCK_DATE
FROM v_deliveries d JOIN v_sap s ON CAST(d.RECORD_ID AS VARCHAR) = s.SALES_DOCUMENT""")
def _(spark, sf):
    d, s = v.deliveries(spark, sf).alias("d"), v.sap(spark, sf).alias("s")
    return d.join(s, F.col("d.RECORD_ID").cast("string") == F.col("s.SALES_DOCUMENT")).select(
        "d.RECORD_ID", F.col("d.STATUS").alias("TRUCK_STATUS"), "s.SHIPMENT_STATUS",
        F.col("s.DELIVERY_DATE").alias("SAP_DATE"), F.col("d.DELIVERY_DATE").alias("TRUCK_DATE"))


check("prj_audit_columns", f"{ctes('v_states')} SELECT SNO, STATE, {AUDIT_SQL} FROM v_states")(
    lambda spark, sf: sh.with_audit(v.states(spark, sf).select("SNO", "STATE"), RUN)
)
check("prj_literal_tag", "SELECT s_suppkey, 'NRL_ABUJA' AS STATION FROM supplier")(
    lambda spark, sf: sh.with_tag(v.table(spark, sf, "supplier").select("s_suppkey"), "STATION", "NRL_ABUJA")
)
check("prj_drop", f"{ctes('v_states')} SELECT LOCAL_GOVERNMENT_AREA FROM v_states")(
    lambda spark, sf: v.states(spark, sf).drop("STATE", "SNO")
)
check("prj_cast_list", f"""{ctes('v_tweets')} SELECT author, CAST(follower_count AS VARCHAR) AS follower_count, CAST(favorite_count AS VARCHAR) AS favorite_count, language AS tweet_language FROM v_tweets""")(
    lambda spark, sf: sh.stringify(v.tweets(spark, sf), ["author", "follower_count", "favorite_count", ("language", "tweet_language")])
)
check("prj_row_sum", f"""{ctes('v_tweets')} SELECT tweet_id, coalesce(favorite_count, 0) + coalesce(retweets, 0) AS interactions FROM v_tweets""")(
    lambda spark, sf: sh.interactions(v.tweets(spark, sf)).select("tweet_id", "interactions")
)

# ---- filters ---------------------------------------------------------------

check("flt_channel_or_like", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, DISTRIBUTION_CHANNEL, DELIVERY_STATION FROM v_sap
WHERE trim(lower(DISTRIBUTION_CHANNEL)) = 'affiliate station' OR trim(lower(DELIVERY_STATION)) LIKE '% mega %'""")(
    lambda spark, sf: fl.affiliate_or_mega(v.sap(spark, sf)).select("DISPATCH_NUMBER", "DISTRIBUTION_CHANNEL", "DELIVERY_STATION")
)
check("flt_not_null", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, DELIVERY_DATE FROM v_sap WHERE DELIVERY_DATE IS NOT NULL""")(
    lambda spark, sf: fl.require(v.sap(spark, sf), "DELIVERY_DATE").select("DISPATCH_NUMBER", "DELIVERY_DATE")
)
check("flt_station_eq", f"""{ctes('v_deliveries')} SELECT RECORD_ID, STATION, QUANTITY FROM v_deliveries WHERE STATION = 'ST_7'""")(
    lambda spark, sf: fl.for_station(v.deliveries(spark, sf), "ST_7").select("RECORD_ID", "STATION", "QUANTITY")
)
check("flt_dropna_any", f"""{ctes('v_tweets')} SELECT tweet_id, favorite_count, location FROM v_tweets WHERE favorite_count IS NOT NULL AND location IS NOT NULL""")(
    lambda spark, sf: fl.complete_rows(v.tweets(spark, sf).select("tweet_id", "favorite_count", "location"))
)
check("snk_touched_partitions", f"""{ctes('v_meter')} SELECT DISTINCT SALES_DATE FROM v_meter""")(
    lambda spark, sf: ag.touched(v.meter(spark, sf), "SALES_DATE")
)
check("set_distinct_col", f"""{ctes('v_sap')} SELECT DISTINCT DELIVERY_STATION FROM v_sap""")(
    lambda spark, sf: ag.distinct_values(v.sap(spark, sf), "DELIVERY_STATION")
)


@check("set_union_days", f"""{ctes('v_deliveries', 'v_meter')} SELECT STATION, DELIVERY_DATE AS BUSINESS_DATE, STATUS, RECORD_ID FROM v_deliveries
UNION ALL SELECT STATION, SALES_DATE, STATUS, RECORD_ID FROM v_meter""")
def _(spark, sf):
    a = v.deliveries(spark, sf).select("STATION", F.col("DELIVERY_DATE").alias("BUSINESS_DATE"), "STATUS", "RECORD_ID")
    b = v.meter(spark, sf).select("RECORD_ID", "STATUS", F.col("SALES_DATE").alias("BUSINESS_DATE"), "STATION")
    return sh.union_all(a, b)


# ---- scalar functions --------------------------------------------------------

check("str_trim_lower_upper", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, trim(lower(DISTRIBUTION_CHANNEL)) AS low, trim(upper(DELIVERY_STATION)) AS up FROM v_sap""")(
    lambda spark, sf: v.sap(spark, sf).select("DISPATCH_NUMBER", fx.norm("DISTRIBUTION_CHANNEL").alias("low"), fx.shout("DELIVERY_STATION").alias("up"))
)
check("str_split_token", f"""{ctes('v_tweets')} SELECT tweet_id, string_split(location, ',')[2] AS second, string_split(location, ' ')[1] AS word FROM v_tweets""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", fx.token("location", ",", 1).alias("second"), fx.token("location", " ", 0).alias("word"))
)
check("str_length_pad", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, CASE WHEN length(split_part(SALES_STAMP, ' ', 2)) = 4 THEN '0' || split_part(SALES_STAMP, ' ', 2) ELSE split_part(SALES_STAMP, ' ', 2) END AS clock FROM v_dodo_text""")(
    lambda spark, sf: v.dodo_text(spark, sf).select("SAP_PAYMENT_NUMBER", fx.pad_time(fx.token("SALES_STAMP", " ", 1)).alias("clock"))
)
check("str_concat", f"""{ctes('v_tweets')} SELECT tweet_id, author || ' ' || location AS who FROM v_tweets""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", F.concat("author", F.lit(" "), "location").alias("who"))
)
check("str_concat_ws", f"""{ctes('v_articles')} SELECT _id, array_to_string(keywords, ',') AS joined FROM v_articles""")(
    lambda spark, sf: v.articles(spark, sf).select("_id", fx.join_text(",", "keywords").alias("joined"))
)
check("str_regexp_replace", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, replace(QUANTITY, ',', '') AS quantity, replace(CUSTOMER_NAME, '''', '') AS customer FROM v_dodo_text""")(
    lambda spark, sf: v.dodo_text(spark, sf).select("SAP_PAYMENT_NUMBER", fx.strip("QUANTITY", ",").alias("quantity"), fx.strip("CUSTOMER_NAME", "'").alias("customer"))
)
check("str_like", f"""{ctes('v_sap')} SELECT DELIVERY_STATION, count(*) AS n FROM v_sap WHERE lower(DELIVERY_STATION) LIKE '% mega %' GROUP BY 1""")(
    lambda spark, sf: v.sap(spark, sf).where(F.lower("DELIVERY_STATION").like("% mega %")).groupBy("DELIVERY_STATION").agg(F.count("*").alias("n"))
)
check("num_clean_cast", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, TRY_CAST(replace(QUANTITY_SOLD, ',', '') AS DOUBLE) AS quantity_sold FROM v_dodo_text""")(
    lambda spark, sf: v.dodo_text(spark, sf).select("SAP_PAYMENT_NUMBER", fx.clean_double("QUANTITY_SOLD").alias("quantity_sold"))
)
check("num_cast_int", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, TRY_CAST(split_part(SALES_STAMP, '/', 1) AS INTEGER) AS day, CAST(trunc(AMOUNT_PAID) AS INTEGER) AS paid FROM v_dodo_text""")(
    lambda spark, sf: v.dodo_text(spark, sf).select("SAP_PAYMENT_NUMBER", fx.clean_int(fx.token("SALES_STAMP", "/", 0)).alias("day"), fx.clean_int("AMOUNT_PAID").alias("paid"))
)
check("num_round", """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS up, round_even(o_orderkey / 4.0, 1) AS even FROM orders""")(
    lambda spark, sf: v.table(spark, sf, "orders").select(
        "o_orderkey", fx.round_half_up(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("up"),
        fx.round_half_even(F.col("o_orderkey") / 4, 1).alias("even"))
)
check("num_arith_div", """SELECT l_orderkey, l_linenumber, l_extendedprice, round(l_quantity * 0.5 / nullif(l_discount, 0), 4) AS ratio FROM lineitem""")(
    lambda spark, sf: v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.round(fx.safe_div(F.col("l_quantity") * 0.5, "l_discount"), 4).alias("ratio"))
)
check("cond_when", f"""{ctes('v_tweets')} SELECT tweet_id, CAST(CASE WHEN favorite_count > 5 THEN 1 ELSE 0 END AS INTEGER) AS liked FROM v_tweets""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", fx.flag(F.col("favorite_count") > 5).alias("liked"))
)
check("cond_coalesce_fill", f"""{ctes('v_tweets')} SELECT tweet_id, coalesce(timezone, location, 'UNKNOWN') AS place FROM v_tweets""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", fx.first_known("timezone", "location", default="UNKNOWN").alias("place"))
)
check("dt_to_date", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, CAST(strptime(SALES_STAMP, '%d/%m/%Y %H:%M') AS DATE) AS day, COMPLETED_ON AS done FROM v_dodo_text""")(
    lambda spark, sf: v.dodo_text(spark, sf).select(
        "SAP_PAYMENT_NUMBER", fx.parse_date("SALES_STAMP", fx.FEED_STAMP).alias("day"),
        fx.parse_date(F.date_format("COMPLETED_ON", "yyyyMMdd")).alias("done"))
)
check("dt_format", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d8, strftime(o_orderdate, '%Y%m') AS d6, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%a') AS dow FROM orders""")(
    lambda spark, sf: v.table(spark, sf, "orders").select(
        "o_orderkey", fx.fmt_date("o_orderdate").alias("d8"), fx.fmt_date("o_orderdate", "yyyyMM").alias("d6"),
        fx.fmt_date("o_orderdate", "yyyy-MM-dd").alias("iso"), fx.fmt_date("o_orderdate", "EEE").alias("dow"))
)
check("dt_datediff", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, CAST(DELIVERY_DATE - DISPATCH_DATE AS INTEGER) AS days FROM v_sap""")(
    lambda spark, sf: v.sap(spark, sf).select("DISPATCH_NUMBER", fx.days_between("DELIVERY_DATE", "DISPATCH_DATE").alias("days"))
)
check("dt_date_add", """SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(trunc(o_totalprice / 10000) AS INTEGER) AS due FROM orders""")(
    lambda spark, sf: v.table(spark, sf, "orders").select(
        "o_orderkey", fx.plus_days(F.to_date("o_orderdate"), F.floor(F.col("o_totalprice") / 10000)).alias("due"))
)
check("dt_month_key", """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key FROM orders""")(
    lambda spark, sf: v.table(spark, sf, "orders").select("o_orderkey", fx.month_key("o_orderdate").alias("month_key"), fx.day_key("o_orderdate").alias("day_key"))
)
check("dt_sequence", f"""{ctes('v_sap')} SELECT DISPATCH_NUMBER, CAST(DELIVERY_DATE - DISPATCH_DATE + 1 AS INTEGER) AS n FROM v_sap """)(
    lambda spark, sf: v.sap(spark, sf).select("DISPATCH_NUMBER", F.size(fx.days("DISPATCH_DATE", "DELIVERY_DATE")).alias("n"))
)
check("py_to_datetime", f"""{ctes('v_tweets')} SELECT tweet_id, CAST(CAST(tweet_date AS TIMESTAMP) AS DATE) AS day, strftime(CAST(tweet_date AS TIMESTAMP), '%H:%M:%S') AS clock FROM v_tweets""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", fx.date_part("tweet_date").alias("day"), fx.time_part("tweet_date").alias("clock"))
)
check("arr_split_words", r"""SELECT doc_id, len(list_filter(string_split_regex(trim(text, E' '), '\s+'), lambda w: w <> '')) AS n_words FROM documents""")(
    lambda spark, sf: v.table(spark, sf, "documents").select("doc_id", F.size(fx.words("text")).cast("bigint").alias("n_words"))
)

# ---- cleaning ----------------------------------------------------------------

check("cln_date_created", f"""{ctes('v_deliveries')} SELECT RECORD_ID, strftime(strptime(DATE_CREATED, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS DATE_CREATED FROM v_deliveries""")(
    lambda spark, sf: cl.clean_created(v.deliveries(spark, sf)).select("RECORD_ID", "DATE_CREATED")
)
check("cln_sales_date_time", f"""{ctes('v_dodo_text')} SELECT SAP_PAYMENT_NUMBER, CAST(strptime(SALES_STAMP, '%d/%m/%Y %H:%M') AS DATE) AS SALES_DATE, split_part(SALES_STAMP, ' ', 2) AS SALES_TIME FROM v_dodo_text""")(
    lambda spark, sf: cl.split_sales_date(v.dodo_text(spark, sf).withColumnRenamed("SALES_STAMP", "SALES_DATE")).select("SAP_PAYMENT_NUMBER", "SALES_DATE", "SALES_TIME")
)
check("cln_dodo_ids", f"""{ctes('v_dodo')} SELECT SAP_PAYMENT_NUMBER, SAP_QUOTATION_NUMBER, DELIVERY_DOC_NUMBER, SHIPMENT_DOC_NUMBER FROM v_dodo""")(
    lambda spark, sf: cl.clean_doc_ids(v.dodo_text(spark, sf)).select("SAP_PAYMENT_NUMBER", "SAP_QUOTATION_NUMBER", "DELIVERY_DOC_NUMBER", "SHIPMENT_DOC_NUMBER")
)
check("cln_quantities", f"""{ctes('v_dodo')} SELECT SAP_PAYMENT_NUMBER, QUANTITY, QUANTITY_SOLD, QUANTITY_RECEIVED FROM v_dodo""")(
    lambda spark, sf: cl.clean_quantities(v.dodo_text(spark, sf), sc.DODO_QUANTITIES).select("SAP_PAYMENT_NUMBER", *sorted(sc.DODO_QUANTITIES))
)
check("cln_state_name", f"""{ctes('v_states')} SELECT SNO AS STATE_ID, upper(split_part(STATE, ' ', 1)) AS STATE_NAME, upper(LOCAL_GOVERNMENT_AREA) AS LOCAL_GOVERNMENT_AREA FROM v_states""")(
    lambda spark, sf: cl.clean_states(v.states(spark, sf))
)
check("cln_compact_date", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m%d') AS compact FROM orders""")(
    lambda spark, sf: cl.compact_date(
        v.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "day"
    ).withColumn("compact", fx.fmt_date("day"))
)


def dodo(spark, sf):
    """The order report after cleaning."""
    df = cl.split_sales_date(v.dodo_text(spark, sf).withColumnRenamed("SALES_STAMP", "SALES_DATE"))
    df = cl.clean_quantities(cl.clean_doc_ids(df), sc.DODO_QUANTITIES)
    return sh.apply_contract(df, [c for c in sc.DODO_COLUMNS if c != "FILE_NAME"])


check("feed_dodo_silver", f"{ctes('v_dodo')} SELECT * FROM v_dodo")(dodo)
