"""Domain feeds derived from the test tables: as DataFrames, and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast import run as runs

RUN = runs.at("2024-02-01", "2024-02-01T06:30:00")
AUDIT_SQL = (
    "CAST(20240201 AS INTEGER) AS RUN_DATE_ID, CAST(1706769000 AS BIGINT) AS INSERT_LOAD_TIME_ID, "
    "TIMESTAMP '2024-02-01 06:30:00' AS INSERT_LOAD_TIME"
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _station(key: str):
    return F.concat(F.lit("ST_"), F.col(key))


def _created(day: str, key: str):
    """dd/MM/yyyy H:mm text, single-digit hours unpadded."""
    return F.concat(
        F.date_format(day, "dd/MM/yyyy"), F.lit(" "), (F.col(key) % 24).cast("string"), F.lit(":"),
        F.lpad((F.col(key) % 60).cast("string"), 2, "0"),
    )


def deliveries(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("RECORD_ID"), _station("c_nationkey").alias("STATION"),
        F.col("o_orderpriority").alias("MATERIAL"), F.col("o_totalprice").alias("QUANTITY"),
        F.col("o_orderstatus").alias("STATUS"), F.to_date("o_orderdate").alias("DELIVERY_DATE"),
        _created("o_orderdate", "o_orderkey").alias("DATE_CREATED"),
    )


def meter(spark, sf):
    l, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    return l.join(o.join(c, o.o_custkey == c.c_custkey), l.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("RECORD_ID"), _station("c_nationkey").alias("STATION"),
        F.concat(F.lit("M"), F.col("l_linenumber")).alias("METER_DESCRIPTION"),
        F.col("o_orderpriority").alias("PRODUCT"),
        F.floor(F.col("l_extendedprice") - F.col("l_quantity")).cast("int").alias("PREVIOUS_READING"),
        F.floor("l_extendedprice").cast("int").alias("CURRENT_READING"),
        F.col("l_quantity").alias("VOLUME"),
        F.when(F.col("l_returnflag") == "R", "Return").otherwise("Sales").alias("TYPE"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UNIT_PRICE"),
        F.col("l_extendedprice").alias("SALES_VALUE"), F.col("l_discount").alias("DEALER_COMMISSION"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("DEALER_COMMISSION_AMOUNT"),
        F.col("l_linestatus").alias("STATUS"), F.to_date("l_shipdate").alias("SALES_DATE"),
        _created("l_shipdate", "l_orderkey").alias("DATE_CREATED"),
    )


def stock(spark, sf):
    l, o, p, s = (table(spark, sf, t) for t in ("lineitem", "orders", "part", "supplier"))
    return (
        l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
        .join(s, l.l_suppkey == s.s_suppkey).select(
            F.col("l_orderkey").alias("RECORD_ID"), _station("s_nationkey").alias("STATION"),
            F.col("p_brand").alias("TANK_DESCRIPTION"), F.col("o_orderpriority").alias("PRODUCT"),
            F.floor("l_quantity").cast("int").alias("DIP_READING"), F.col("l_linestatus").alias("STATUS"),
            F.to_date("l_shipdate").alias("SALES_DATE"), _created("l_shipdate", "l_orderkey").alias("DATE_CREATED"),
        )
    )


def _dealer_name():
    return F.concat(
        F.lit("ULTRA "), F.when(F.col("c_nationkey") % 2 == 0, "MEGA ").otherwise("MINI "), F.lit("ST'"),
        F.col("c_nationkey"),
    )


def sap(spark, sf):
    l, o, c, s = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "supplier"))
    key = F.col("l_orderkey")
    dispatch = F.to_date("l_shipdate")
    # the narrow joins first: the largest table meets the orders with their customers, not each of the two
    return (
        l.join(s, l.l_suppkey == s.s_suppkey).join(o.join(c, o.o_custkey == c.c_custkey), l.l_orderkey == o.o_orderkey).select(
            F.concat(F.lit(" "), key, F.lit(" ")).alias("SALES_QUOTATION"),
            F.concat(F.lit("RRR"), F.col("l_partkey")).alias("RRR_NUMBER"), key.cast("string").alias("SALES_DOCUMENT"),
            F.concat(F.lit("D"), key, F.lit("-"), F.col("l_linenumber")).alias("DISPATCH_NUMBER"),
            F.concat(F.lit("W"), key).alias("WAYBILL_NUMBER"), F.concat(F.lit("V"), F.col("l_suppkey")).alias("RESERVATION_NO"),
            F.concat(F.lit("T"), F.col("l_linenumber")).alias("TICKET_NUMBER"), F.col("s_name").alias("LOADING_DEPOT_NAME"),
            F.col("o_orderpriority").alias("PRODUCT_TYPE"), F.lit("B1").alias("BATCH"),
            F.col("l_returnflag").alias("TRANSACTION_TYPE"), F.col("l_quantity").alias("QUANTITY_LOADED"),
            F.lit("L12").alias("TRANSACTION_UOM12"), F.to_date("l_shipdate").alias("LOADING_DATE"),
            F.date_format("l_shipdate", "MM").alias("MONTH"), F.col("s_name").alias("REGISTERED_OWNER"),
            F.concat(F.lit("TRK"), F.col("l_suppkey")).alias("VEHICLE_NUMBER"),
            F.concat(F.lit("DEP"), F.col("s_nationkey")).alias("RECEIVING_DEPOT"),
            F.col("l_linestatus").alias("TRANSIT_TRUCK_STATUS"), F.col("l_quantity").alias("QUANTITY_ORDERED"),
            F.col("l_quantity").alias("QUANTITY_DISPATCHED"), dispatch.alias("DISPATCH_DATE"),
            F.col("l_linestatus").alias("SHIPMENT_STATUS"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("DESTINATION"),
            _dealer_name().alias("DELIVERY_STATION"),
            F.when(F.col("c_mktsegment") == "BUILDING", " Affiliate Station ").otherwise(F.col("c_mktsegment")).alias("DISTRIBUTION_CHANNEL"),
            F.when((F.col("l_linestatus") == "O") & (key % 3 == 0), None).otherwise(F.date_add(dispatch, (key % 9).cast("int"))).alias("DELIVERY_DATE"),
            (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("QUANTITY_DELIVERED"),
            F.lit("L28").alias("TRANSACTION_UOM28"), F.lit("loader").alias("CREATED_BY"), F.lit("checker").alias("CHANGED_BY"),
        )
    )


def dodo_text(spark, sf):
    """The order report as it arrives: quoted ids, comma numbers, one stamp column."""
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    key = F.col("o_orderkey")
    # Every seventh order carries a number no loading row has, so both sides have unmatched rows.
    quotation = key + F.when(key % 7 == 0, 1000000000).otherwise(0)
    amount = F.format_number(F.col("o_totalprice"), 2)
    return (
        o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey).select(
            F.lower(_dealer_name()).alias("CUSTOMER_NAME"), F.concat(F.lit("'00"), quotation).alias("SAP_QUOTATION_NUMBER"),
            F.col("o_orderpriority").alias("PRODUCT"), amount.alias("QUANTITY"),
            F.concat(F.lit("R"), F.col("o_custkey")).alias("RRR_NUMBER"), F.concat(F.lit("P"), key).alias("SAP_PAYMENT_NUMBER"),
            F.col("o_totalprice").alias("AMOUNT_PAID"), F.concat(F.lit("S"), key).alias("SAP_SALES_ORDER_NUMBER"),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(amount).alias("QUANTITY_SOLD"),
            F.concat(F.lit("'"), key).alias("DELIVERY_DOC_NUMBER"), F.concat(F.lit("'"), key, F.lit("'")).alias("SHIPMENT_DOC_NUMBER"),
            F.when(F.col("o_orderstatus") == "F", "-9999").otherwise(amount).alias("QUANTITY_RECEIVED"),
            F.concat(F.lit("PL"), F.col("o_custkey")).alias("DELIVERY_TRUCK_PLATE_NUMBER"), F.lit("C1").alias("CLEARING_DOC_NUMBER"),
            _created("o_orderdate", "o_orderkey").alias("SALES_STAMP"), F.col("n_name").alias("STATE"),
            F.col("r_name").alias("REGION"),
            F.when(F.col("o_orderstatus") == "O", None).otherwise(F.date_add(F.to_date("o_orderdate"), (key % 11).cast("int"))).alias("COMPLETED_ON"),
        )
    )


def states(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("SNO"), F.concat_ws(" ", "r_name", "n_name").alias("STATE"),
        F.lower("n_name").alias("LOCAL_GOVERNMENT_AREA"),
    )


def tweets(spark, sf):
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    opener = F.when(i % 5 == 0, "@user_one not very good service, ").when(i % 5 == 1, "Really terrible @Küche9 queue ") \
        .when(i % 5 == 2, "The best and fast ").when(i % 5 == 3, "").otherwise("No no bad, extremely slow ")
    link = F.when(i % 4 == 0, " https://t.co/abcTHE1 after").when(i % 4 == 1, " http://x.example/p?q=the").otherwise("")
    place = F.when(i % 5 == 0, "Lagos, Nigeria").when(i % 5 == 1, "Abuja Nigeria").when(i % 5 == 2, "Kano") \
        .when(i % 5 == 3, None).otherwise(F.concat("lang", F.lit(" X, "), "source"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int"))
    return d.select(
        i.alias("tweet_id"), F.concat(F.lit("user_"), i % 97).alias("author"),
        F.concat(day, F.lit(" 0"), i % 10, F.lit(":15:00")).alias("tweet_date"), (i % 1000).alias("follower_count"),
        (i % 100).alias("friends_count"), F.lit("False").alias("account_verified"),
        F.when(i % 11 != 0, i % 13).alias("favorite_count"), F.concat(day, F.lit(" 10:00:00")).alias("accout_creation"),
        (F.col("n_chars") % 7).alias("retweets"), F.concat(opener, "text", link).alias("tweet_text"),
        F.col("source").alias("userdesc"), F.lit("web").alias("device"), F.lit(None).cast("string").alias("timezone"),
        F.col("lang").alias("language"), F.lit("False").alias("following"), F.lit("False").alias("follow_request_sent"),
        F.lit("p").alias("profile"), F.col("n_chars").alias("statuses_count"), place.alias("location"),
        F.col("lang").alias("filter_col"), F.when(i % 4 == 0, "2024-01-30").otherwise("2024-01-31").alias("load_date"),
    )


def articles(spark, sf):
    d, e = table(spark, sf, "documents"), table(spark, sf, "events")
    i = F.col("doc_id")
    lead = F.when(i % 3 == 0, "Wonderful results: ").when(i % 3 == 1, "never happy, ").otherwise("")
    keywords = F.when(i % 10 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.col("lang"), F.concat(F.col("lang"), F.lit(" "), F.col("source")))
    )
    at = F.coalesce(F.col("ts").cast("timestamp"), F.lit("2024-01-05 00:00:00").cast("timestamp"))
    return d.join(e, d.doc_id == e.event_id, "left").select(
        i.alias("_id"), F.col("source").alias("domain"),
        F.concat(F.lit("http://"), F.col("source"), F.lit("/"), F.floor(i / 2)).alias("source"),
        F.concat(lead, F.col("text")).alias("body"), keywords.alias("keywords"),
        F.date_trunc("second", at).alias("createdAt"), F.date_trunc("second", at).alias("updatedAt"),
    )


# ---------------------------------------------------------------------------
# The same feeds as SQL.
# ---------------------------------------------------------------------------

def _sql_created(day: str, key: str) -> str:
    return (
        f"strftime({day}, '%d/%m/%Y') || ' ' || CAST({key} % 24 AS VARCHAR) || ':' || "
        f"lpad(CAST({key} % 60 AS VARCHAR), 2, '0')"
    )


_DEALER = "'ULTRA ' || CASE WHEN c_nationkey % 2 = 0 THEN 'MEGA ' ELSE 'MINI ' END || 'ST''' || c_nationkey"
_AMOUNT = "format('{:,.2f}', o_totalprice)"

VIEWS = {
    "v_deliveries": f"""
SELECT o_orderkey AS RECORD_ID, 'ST_' || c_nationkey AS STATION, o_orderpriority AS MATERIAL,
       o_totalprice AS QUANTITY, o_orderstatus AS STATUS, CAST(o_orderdate AS DATE) AS DELIVERY_DATE,
       {_sql_created('o_orderdate', 'o_orderkey')} AS DATE_CREATED
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_meter": f"""
SELECT l_orderkey AS RECORD_ID, 'ST_' || c_nationkey AS STATION, 'M' || l_linenumber AS METER_DESCRIPTION,
       o_orderpriority AS PRODUCT, CAST(floor(l_extendedprice - l_quantity) AS INTEGER) AS PREVIOUS_READING,
       CAST(floor(l_extendedprice) AS INTEGER) AS CURRENT_READING, l_quantity AS VOLUME,
       CASE WHEN l_returnflag = 'R' THEN 'Return' ELSE 'Sales' END AS TYPE,
       l_extendedprice / l_quantity AS UNIT_PRICE, l_extendedprice AS SALES_VALUE,
       l_discount AS DEALER_COMMISSION, l_extendedprice * l_discount AS DEALER_COMMISSION_AMOUNT,
       l_linestatus AS STATUS, CAST(l_shipdate AS DATE) AS SALES_DATE,
       {_sql_created('l_shipdate', 'l_orderkey')} AS DATE_CREATED
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "v_stock": f"""
SELECT l_orderkey AS RECORD_ID, 'ST_' || s_nationkey AS STATION, p_brand AS TANK_DESCRIPTION,
       o_orderpriority AS PRODUCT, CAST(floor(l_quantity) AS INTEGER) AS DIP_READING, l_linestatus AS STATUS,
       CAST(l_shipdate AS DATE) AS SALES_DATE, {_sql_created('l_shipdate', 'l_orderkey')} AS DATE_CREATED
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey""",
    "v_sap": f"""
SELECT ' ' || l_orderkey || ' ' AS SALES_QUOTATION, 'RRR' || l_partkey AS RRR_NUMBER,
       CAST(l_orderkey AS VARCHAR) AS SALES_DOCUMENT, 'D' || l_orderkey || '-' || l_linenumber AS DISPATCH_NUMBER,
       'W' || l_orderkey AS WAYBILL_NUMBER, 'V' || l_suppkey AS RESERVATION_NO, 'T' || l_linenumber AS TICKET_NUMBER,
       s_name AS LOADING_DEPOT_NAME, o_orderpriority AS PRODUCT_TYPE, 'B1' AS BATCH, l_returnflag AS TRANSACTION_TYPE,
       l_quantity AS QUANTITY_LOADED, 'L12' AS TRANSACTION_UOM12, CAST(l_shipdate AS DATE) AS LOADING_DATE,
       strftime(l_shipdate, '%m') AS MONTH, s_name AS REGISTERED_OWNER, 'TRK' || l_suppkey AS VEHICLE_NUMBER,
       'DEP' || s_nationkey AS RECEIVING_DEPOT, l_linestatus AS TRANSIT_TRUCK_STATUS, l_quantity AS QUANTITY_ORDERED,
       l_quantity AS QUANTITY_DISPATCHED, CAST(l_shipdate AS DATE) AS DISPATCH_DATE, l_linestatus AS SHIPMENT_STATUS,
       'N' || c_nationkey AS DESTINATION, {_DEALER} AS DELIVERY_STATION,
       CASE WHEN c_mktsegment = 'BUILDING' THEN ' Affiliate Station ' ELSE c_mktsegment END AS DISTRIBUTION_CHANNEL,
       CASE WHEN l_linestatus = 'O' AND l_orderkey % 3 = 0 THEN NULL
            ELSE CAST(l_shipdate AS DATE) + CAST(l_orderkey % 9 AS INTEGER) END AS DELIVERY_DATE,
       l_quantity * (1 - l_discount) AS QUANTITY_DELIVERED, 'L28' AS TRANSACTION_UOM28, 'loader' AS CREATED_BY,
       'checker' AS CHANGED_BY
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey""",
    "v_dodo_text": f"""
SELECT lower({_DEALER}) AS CUSTOMER_NAME,
       '''00' || (o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1000000000 ELSE 0 END) AS SAP_QUOTATION_NUMBER,
       o_orderpriority AS PRODUCT, {_AMOUNT} AS QUANTITY, 'R' || o_custkey AS RRR_NUMBER,
       'P' || o_orderkey AS SAP_PAYMENT_NUMBER, o_totalprice AS AMOUNT_PAID, 'S' || o_orderkey AS SAP_SALES_ORDER_NUMBER,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE {_AMOUNT} END AS QUANTITY_SOLD,
       '''' || o_orderkey AS DELIVERY_DOC_NUMBER, '''' || o_orderkey || '''' AS SHIPMENT_DOC_NUMBER,
       CASE WHEN o_orderstatus = 'F' THEN '-9999' ELSE {_AMOUNT} END AS QUANTITY_RECEIVED,
       'PL' || o_custkey AS DELIVERY_TRUCK_PLATE_NUMBER, 'C1' AS CLEARING_DOC_NUMBER,
       {_sql_created('o_orderdate', 'o_orderkey')} AS SALES_STAMP, n_name AS STATE, r_name AS REGION,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) END AS COMPLETED_ON
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "v_dodo": """
SELECT CUSTOMER_NAME, replace(SAP_QUOTATION_NUMBER, '''00', '') AS SAP_QUOTATION_NUMBER, PRODUCT,
       CAST(replace(QUANTITY, ',', '') AS DOUBLE) AS QUANTITY, RRR_NUMBER, SAP_PAYMENT_NUMBER, AMOUNT_PAID,
       SAP_SALES_ORDER_NUMBER, TRY_CAST(replace(QUANTITY_SOLD, ',', '') AS DOUBLE) AS QUANTITY_SOLD,
       replace(DELIVERY_DOC_NUMBER, '''', '') AS DELIVERY_DOC_NUMBER,
       replace(SHIPMENT_DOC_NUMBER, '''', '') AS SHIPMENT_DOC_NUMBER,
       nullif(CAST(replace(QUANTITY_RECEIVED, ',', '') AS DOUBLE), -9999) AS QUANTITY_RECEIVED,
       DELIVERY_TRUCK_PLATE_NUMBER, CLEARING_DOC_NUMBER,
       CAST(strptime(SALES_STAMP, '%d/%m/%Y %H:%M') AS DATE) AS SALES_DATE, STATE, REGION, COMPLETED_ON,
       split_part(SALES_STAMP, ' ', 2) AS SALES_TIME
FROM v_dodo_text""",
    "v_states": """
SELECT n_nationkey AS SNO, r_name || ' ' || n_name AS STATE, lower(n_name) AS LOCAL_GOVERNMENT_AREA
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_tweets": """
SELECT doc_id AS tweet_id, 'user_' || (doc_id % 97) AS author,
       (DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER)) || ' 0' || (doc_id % 10) || ':15:00' AS tweet_date,
       doc_id % 1000 AS follower_count, doc_id % 100 AS friends_count, 'False' AS account_verified,
       CASE WHEN doc_id % 11 <> 0 THEN doc_id % 13 END AS favorite_count,
       (DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER)) || ' 10:00:00' AS accout_creation, n_chars % 7 AS retweets,
       CASE doc_id % 5 WHEN 0 THEN '@user_one not very good service, ' WHEN 1 THEN 'Really terrible @Küche9 queue '
            WHEN 2 THEN 'The best and fast ' WHEN 3 THEN '' ELSE 'No no bad, extremely slow ' END || text ||
       CASE doc_id % 4 WHEN 0 THEN ' https://t.co/abcTHE1 after' WHEN 1 THEN ' http://x.example/p?q=the' ELSE '' END AS tweet_text,
       source AS userdesc, 'web' AS device, CAST(NULL AS VARCHAR) AS timezone, lang AS language, 'False' AS following,
       'False' AS follow_request_sent, 'p' AS profile, n_chars AS statuses_count,
       CASE doc_id % 5 WHEN 0 THEN 'Lagos, Nigeria' WHEN 1 THEN 'Abuja Nigeria' WHEN 2 THEN 'Kano' WHEN 3 THEN NULL
            ELSE lang || ' X, ' || source END AS location,
       lang AS filter_col, CASE WHEN doc_id % 4 = 0 THEN '2024-01-30' ELSE '2024-01-31' END AS load_date
FROM documents""",
    "v_articles": """
SELECT doc_id AS _id, d.source AS domain, 'http://' || d.source || '/' || (doc_id // 2) AS source,
       CASE doc_id % 3 WHEN 0 THEN 'Wonderful results: ' WHEN 1 THEN 'never happy, ' ELSE '' END || text AS body,
       CASE WHEN doc_id % 10 = 0 THEN CAST([] AS VARCHAR[]) ELSE [lang, lang || ' ' || d.source] END AS keywords,
       date_trunc('second', coalesce(ts, TIMESTAMP '2024-01-05 00:00:00')) AS createdAt,
       date_trunc('second', coalesce(ts, TIMESTAMP '2024-01-05 00:00:00')) AS updatedAt
FROM documents d LEFT JOIN events e ON doc_id = event_id""",
}
NEEDS = {"v_dodo": ["v_dodo_text"]}


def ctes(*names: str) -> str:
    """``WITH`` clause holding the named feeds and what they are built from."""
    order: list[str] = []
    for n in names:
        for need in [*NEEDS.get(n, []), n]:
            if need not in order:
                order.append(need)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
