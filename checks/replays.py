"""Sinks and whole loads run more than once: late rows, rows without a key, empty batches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stationcast import schemas as sc
from stationcast.functions.columns import month_key
from stationcast.operators import articles as art
from stationcast.operators.shaping import with_audit
from stationcast.plans import gold
from stationcast.plans import sentiment as sent
from stationcast.plans.lake import Lake
from stationcast.sources import layers as ly

from . import views as v
from .demand import DAILY_PRODUCT_SQL, RAW_SQL, SAP_DODO_SQL, dodo
from .registry import check
from .scratch import fresh
from .text_and_forecast import TWEET_TABLE, WEB_SQL
from .views import AUDIT_SQL, RUN, ctes


def _name(stem: str) -> str:
    return f"default.{stem}_{uuid.uuid4().hex}"


_KEYWORDS = "SELECT domain AS site, source, unnest(CASE WHEN len(keywords) > 0 THEN keywords ELSE [NULL] END) AS keywords FROM v_articles"


def _keyword_rows(spark, sf):
    """Distinct keyword rows; articles without keywords have a null one."""
    rows = art.explode_keywords(v.articles(spark, sf)).select("keywords", "source", F.col("domain").alias("site"))
    return rows.distinct()


@check("snk_warehouse_append", f"{ctes('v_articles')} SELECT DISTINCT keywords, source, site FROM ({_KEYWORDS})")
def _(spark, sf):
    """Three appends of overlapping batches, the first without rows, to a catalog table."""
    name, rows = _name("appended"), _keyword_rows(spark, sf)
    for batch in (rows.limit(0), rows.where("keywords IS NULL OR keywords LIKE '% %'"), rows, rows):
        ly.publish(batch, name, "append", ["keywords", "source"])
    return spark.table(name)


@check("snk_warehouse_overwrite", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    name, rows = _name("overwritten"), v.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    for batch in (rows.withColumn("s_acctbal", -F.col("s_acctbal")), rows):
        ly.publish(batch, name)
    return spark.table(name)


@check("snk_overwrite_partitioned", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey < 20")
def _(spark, sf):
    """Partitions that the new table lacks are gone."""
    path, rows = fresh(spark, "whole"), v.table(spark, sf, "customer")
    ly.write_full(rows.select("c_custkey", "c_acctbal", F.concat(F.lit("OLD "), "c_mktsegment").alias("c_mktsegment")), path, "c_mktsegment")
    ly.write_full(rows.where("c_nationkey < 20").select("c_custkey", "c_acctbal", "c_mktsegment"), path, "c_mktsegment")
    return ly.read_layer(spark, path)


@check("snk_replace_late_rows", f"{ctes('v_deliveries')} SELECT RECORD_ID, STATION, QUANTITY * 2 AS QUANTITY, CAST(strftime(DELIVERY_DATE, '%Y%m') AS INTEGER) AS MONTH_KEY FROM v_deliveries")
def _(spark, sf):
    """Each month's rows come in two files, the second a run later; then the first file comes again, corrected."""
    path, rows = fresh(spark, "late"), v.deliveries(spark, sf).select("RECORD_ID", "STATION", "QUANTITY", month_key("DELIVERY_DATE").alias("MONTH_KEY"))
    rows = rows.withColumn("FILE_NAME", F.when(F.col("RECORD_ID") % 3 == 0, "late.csv").otherwise("first.csv"))
    double = rows.withColumn("QUANTITY", F.col("QUANTITY") * 2)
    first, late = "FILE_NAME = 'first.csv'", "FILE_NAME = 'late.csv'"
    for batch in (rows.where(first), double.where(late), double.where(first), double.where(late)):
        ly.write_replace(batch, path, "MONTH_KEY", "FILE_NAME")
    return ly.read_layer(spark, path).drop("FILE_NAME")


@check("flt_empty_batch", f"{ctes('v_articles')} SELECT DISTINCT keywords, source, site FROM ({_KEYWORDS})")
def _(spark, sf):
    """An empty first batch leaves nothing that a later one trips over."""
    path, rows = fresh(spark, "empty"), _keyword_rows(spark, sf)
    for batch in (rows.limit(0), rows, rows.limit(0)):
        ly.append_new(batch, path, ["keywords", "source"], "site")
    return ly.read_layer(spark, path)


@check("snk_capture_append", "SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM documents")
def _(spark, sf):
    path, rows = fresh(spark, "raw"), v.table(spark, sf, "documents").select("doc_id", "text")
    for _ in range(2):
        ly.append_raw(rows, path)
    return spark.read.schema(rows.schema).json(path)


@check("pipe_web", WEB_SQL)
def _(spark, sf):
    """Two overlapping ranges, then both again: the published table, keyword-less articles included."""
    path, name, raw = fresh(spark, "gold"), _name("web"), v.articles(spark, sf)
    middle = "2024-01-06 00:00:00"
    for start, end in (("2024-01-01 00:00:00", middle), ("2024-01-01 00:00:00", "2025-01-01 00:00:00")) * 2:
        sent.web(spark, raw, path, start, end, name)
    return spark.table(name).select("keywords", "source", "site")


@check("pipe_tweets", f"SELECT author, tweet_date, tweet_time, tweet_text, sentiment, load_date FROM (SELECT DISTINCT * FROM ({TWEET_TABLE}))")
def _(spark, sf):
    """Both load dates, each of them twice."""
    name, raw = _name("tweets"), v.tweets(spark, sf)
    for day in ("2024-01-30", "2024-01-31") * 2:
        sent.tweets(spark, raw, day, name)
    return spark.table(name).select("author", "tweet_date", "tweet_time", "tweet_text", "sentiment", "load_date")


def codo_silver(spark, sf):
    """Silver layers of the three station feeds through the gold plan: the lake and its database."""
    lake, database = Lake(fresh(spark, "codo")), f"gold_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake.root}/{database}'")
    for feed, rows in ((sc.CODO_TRUCKS, v.deliveries(spark, sf)), (sc.CODO_STOCK, v.stock(spark, sf)), (sc.CODO_METER, v.meter(spark, sf))):
        ly.write_full(with_audit(rows.withColumn("FILE_NAME", F.lit("f")), RUN), lake.silver(feed.name))
    gold.codo_gold(spark, lake, RUN, RUN.run_date_id, RUN.run_date_id, database)
    return lake, database


@check("pipe_codo_gold", f"{RAW_SQL}, dsp AS ({DAILY_PRODUCT_SQL}), n AS (SELECT count(*) AS n FROM v_raw) SELECT dsp.*, n AS RAW_ROWS FROM dsp, n")
def _(spark, sf):
    """All rows of the daily table, those without a sales date included, with the number of raw rows."""
    _, database = codo_silver(spark, sf)
    raw = spark.table(f"{database}.codo_raw_features").agg(F.count(F.lit(1)))
    return spark.table(f"{database}.codo_daily_station_product").drop(*sc.AUDIT_COLUMNS).withColumn("RAW_ROWS", raw.scalar())


@check("pipe_sap_dodo_gold", f"{SAP_DODO_SQL} SELECT {', '.join(sc.SAP_DODO)}, {AUDIT_SQL} FROM v_flag")
def _(spark, sf):
    lake, database = Lake(fresh(spark, "sap")), f"gold_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake.root}/{database}'")
    for feed, rows in ((sc.SAP_LOADING, v.sap(spark, sf)), (sc.DODO_ORDERS, dodo(spark, sf))):
        ly.write_full(with_audit(rows, RUN), lake.silver(feed.name))
    gold.sap_dodo_gold(spark, lake, RUN, database)
    return spark.table(f"{database}.sap_dodo_feature_store")
