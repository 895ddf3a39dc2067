"""Silver to gold to forecast and the text flows, end to end on small layers."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from stationcast import schemas as sc
from stationcast.operators import codo
from stationcast.operators.shaping import with_audit
from stationcast.plans import adhoc, forecasts, gold, sentiment
from stationcast.plans.lake import Lake
from stationcast.run import at
from stationcast.sources import documents as docs
from stationcast.sources import layers as ly
from test_demand import METER, STOCK, TRUCK, day

RUN = at("2023-02-01", "2023-02-01T05:00:00")


def fill_codo(spark, lake):
    trucks = [(i, s, "PMS", 100.0 + i, "OK", day(d), None) for i, (s, d) in enumerate((s, d) for s in ("A", "B") for d in (0, 5, 12, 30))]
    meters = [(i, s, "M1", "PMS", 1, 2, 10.0 + d % 7, "Sales", 1.0, 20.0, 0.0, 0.0, "OK", day(d), None)
              for i, (s, d) in enumerate((s, d) for s in ("A", "B") for d in range(40))]
    stock = [(1, "A", "T1", "PMS", 50, "OK", day(1), None), (2, "C", "T9", "PMS", 5, "OK", day(1), None)]
    for feed, data, schema in ((sc.CODO_TRUCKS, trucks, TRUCK), (sc.CODO_METER, meters, METER), (sc.CODO_STOCK, stock, STOCK)):
        df = spark.createDataFrame(data, schema).withColumn("FILE_NAME", F.lit("f"))
        ly.write_replace(with_audit(df, RUN), lake.silver(feed.name), feed.date_column)


def test_codo_gold_forecast_publish(spark, tmp_path):
    lake = Lake(str(tmp_path))
    fill_codo(spark, lake)
    for _ in range(2):
        gold.codo_gold(spark, lake, RUN, 20230201, 20230201)
    raw = spark.table("default.codo_raw_features")
    assert set(sc.CODO_RAW) <= set(raw.columns) and raw.where("STATION = 'C'").count() == 1
    wide = spark.table("default.codo_agg_feature_store")
    assert wide.columns[:31] == sc.CODO_AGG and wide.where("RUN_DATE_ID IS NULL").count() == 0
    f = gold.load_factors(spark, lake, RUN.run_date_id)
    assert rows(wide.select(*sc.CODO_AGG)) == rows(codo.codo_agg(f).select(*sc.CODO_AGG))
    volume, peak = gold.codo_agg_view(spark, lake, RUN)
    assert volume.where("STATION = 'A'").count() > 0 and peak.where("STATION = 'B'").count() > 0

    for name in ("sales", "quantity", "next_delivery"):
        forecasts.run_forecast(spark, lake, RUN, name)
        forecasts.run_forecast(spark, lake, RUN, name)
    model = ly.read_layer(spark, lake.gold("codo_model"))
    # Station A sells on 40 days, all inside or after its delivery windows; 7 more are forecast.
    assert model.where("STATION = 'A'").count() == 47
    assert model.where("ACTUAL_VOLUME_SOLD IS NULL").count() == 14
    forecasts.publish_codo(spark, lake, RUN)
    out = spark.table("default.codo_forecast")
    assert out.where("NEXT_OPTIMAL_ORDER_DATE IS NULL OR ACTUAL_QUANTITY IS NULL").count() == 0 and out.count() > 20
    forecasts.publish_codo(spark, lake, RUN, "default.codo_forecast_open", require_actuals=False)
    assert spark.table("default.codo_forecast_open").count() > out.count()


def test_sap_dodo_gold_forecast_publish(spark, tmp_path):
    lake = Lake(str(tmp_path))
    text = {c: "string" for c in sc.SAP_COLUMNS} | {c: "double" for c in sc.SAP_QUANTITIES} | {c: "date" for c in ("LOADING_DATE", "DISPATCH_DATE", "DELIVERY_DATE")}
    base = dict.fromkeys(sc.SAP_COLUMNS)
    sap = [tuple((base | {"SALES_QUOTATION": f" {i} ", "DELIVERY_STATION": "ULTRA MEGA ST'A" if i % 2 else "ULTRA MINI B", "DISTRIBUTION_CHANNEL": " Affiliate Station ",
                          "QUANTITY_ORDERED": 10.0, "QUANTITY_DELIVERED": 10.0, "LOADING_DATE": day(i), "DISPATCH_DATE": day(i + 1), "DELIVERY_DATE": day(i + 3)}).values()) for i in range(30)]
    sap += [sap[0], tuple((base | {"SALES_QUOTATION": "x", "DELIVERY_STATION": "MEGA OUT", "DISTRIBUTION_CHANNEL": "other", "LOADING_DATE": day(0)}).values())]
    ly.write_replace(with_audit(spark.createDataFrame(sap, ", ".join(f"{k} {v}" for k, v in text.items())).withColumn("FILE_NAME", F.lit("f")), RUN),
                     lake.silver(sc.SAP_LOADING.name), "LOADING_DATE")
    kinds = {c: "string" for c in sc.DODO_COLUMNS} | {c: "double" for c in [*sc.DODO_QUANTITIES, "AMOUNT_PAID"]} | {"SALES_DATE": "date", "COMPLETED_ON": "date"}
    blank = dict.fromkeys(sc.DODO_COLUMNS)
    dodo = [tuple((blank | {"SAP_QUOTATION_NUMBER": str(i), "SALES_DATE": day(i), "QUANTITY": 1.0}).values()) for i in range(35)]
    ly.write_replace(with_audit(spark.createDataFrame(dodo, ", ".join(f"{k} {v}" for k, v in kinds.items())), RUN), lake.silver(sc.DODO_ORDERS.name), "SALES_DATE")

    gold.sap_dodo_gold(spark, lake, RUN)
    table = spark.table("default.sap_dodo_feature_store")
    assert table.count() == 35 and set(table.columns) == {*sc.SAP_DODO, *sc.AUDIT_COLUMNS}
    assert table.where("SALES_QUOTATION IS NULL").count() == 5
    for name in ("orders", "delays"):
        forecasts.run_forecast(spark, lake, RUN, name)
    assert "ULTRA MEGA STA" in {r[0] for r in ly.read_layer(spark, lake.gold("sap_dodo_orders_model")).select("DELIVERY_STATION").distinct().collect()}
    forecasts.publish_sap(spark, lake, RUN)
    out = spark.table("default.sap_dodo_forecast")
    assert out.count() > 0 and out.where("FORCASTED_DELIVERY_DAYS <> 3 AND ACTUAL_DELIVERY_DAYS IS NOT NULL").count() == 0
    assert dict(out.dtypes)["FORECASTED_DATE"] == "string" and len(out.first().FORECASTED_DATE) == 8


TWEET = ("Tweet_id long, Author string, `Tweet Date` string, `Follower Count` int, `Friends Count` int, `Account Verified` string, `Favorite Count` int, "
         "`Accout Creation` string, Retweets int, `Tweet Text` string, UserDesc string, Device string, Timezone string, Language string, Following string, "
         "`Follow Request Sent` string, Profile string, statuses_count int, Location string, filter_col string, load_date string")


def tweet(i, text, fav=None, loc=None):
    return (i, f"u{i % 2}", "2023-01-05 10:11:12", 1, 1, "F", fav, "2020-01-01 00:00:00", 2, text, "d", "web", None, "en", "F", "F", "p", 3, loc, "fuel", "2023-01-05")


def test_tweets_replay(spark):
    raw = spark.createDataFrame([tweet(1, "very good @x fuel", 3, "Lagos, Nigeria"), tweet(2, "bad"), tweet(4, "bad")], TWEET)
    for _ in range(2):
        sentiment.tweets(spark, raw, "2023-01-05")
    got = spark.table("default.tweets_sentiment")
    assert got.columns == sc.TWEETS_SENTIMENT and got.count() == 2
    r = got.where("author = 'u1'").first()
    assert (r.sentiment, r.df_tweet, r.longeractions, r.country, r.tweet_time) == ("0.9", "good fuel", "5", "NIGERIA", "10:11:12")
    assert got.where("author = 'u0'").first().favorite_count is None
    assert sentiment.prepare_tweets(raw.toDF(*[c.replace(" ", "_").lower() for c in raw.columns]), 1).count() == 1


def test_exported_tweets(spark):
    df = spark.createDataFrame([tuple("x" for _ in sc.TWEETS_EXPORT)], [c.replace("_", " ").title() for c in sc.TWEETS_EXPORT])
    for _ in range(2):
        sentiment.load_exported_tweets(df)
    assert spark.table("default.tweets_sentiment_export").count() == 1


ARTICLE = "_id int, __v int, published string, keywords array<string>, domain string, source string, createdAt timestamp, updatedAt timestamp, body string"


def article(i, keywords, source, body="Wonderful infrastructure", domain="site1", when=datetime(2023, 1, 5, 8)):
    return (i, 0, "p", keywords, domain, source, when, when, body)


def test_web_keeps_published_rows(spark, tmp_path):
    path = str(tmp_path / "web")
    one = spark.createDataFrame([article(1, ["fuel", "oil"], "u1"), article(2, ["fuel"], "u1", when=datetime(2023, 1, 6)), article(3, [], "u3"),
                                 article(9, ["late"], "u9", when=datetime(2023, 1, 7))], ARTICLE)
    two = spark.createDataFrame([article(4, [" fuel "], "u1 "), article(5, ["gas"], "u5", "bad")], ARTICLE)
    sentiment.web(spark, one, path, "2023-01-05", "2023-01-07")
    before = spark.read.parquet(path).count()
    assert before == 3
    for _ in range(2):
        sentiment.web(spark, two, path, "2023-01-05", "2023-01-07")
    got = spark.read.parquet(path)
    assert sorted((r.keywords or "", r.source) for r in got.collect())[-1] == ("oil", "u1")
    assert got.where("keywords = 'gas'").first().sentiment == "-0.7" and got.where("trim(keywords) = 'fuel'").count() == 1
    table = spark.table("default.web_sentiment")
    assert sorted(table.columns) == sorted(sc.WEB_SENTIMENT) and table.where("keywords = 'fuel'").first().createdat == "2023-01-05 08:00:00"


def test_document_sources(spark, tmp_path):
    p = str(tmp_path / "d")
    spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, twitter array<string>").write.json(p)
    df = docs.read_docs(spark, p, spark.createDataFrame([], "id int, twitter array<string>").schema)
    assert rows(docs.topics(df)) == [(1, 0, "a"), (1, 1, "b"), (2, None, None)]


def test_adhoc_joins(spark):
    sap = spark.createDataFrame([("ULTRA A", "1", 5.0)], "delivery_station string, sales_document string, quantity_ordered double")
    dodo = spark.createDataFrame([("Ultra a", 2.0), ("other", 1.0)], "customer_name string, quantity_sold double")
    meter = spark.createDataFrame([("1", "m")], "record_id string, x string")
    stock = spark.createDataFrame([("1", "t")], "record_id string, y string")
    assert adhoc.sap_dodo_by_name(sap, dodo).count() == 1
    assert adhoc.meter_stock_by_record(meter, stock).count() == 1
    assert adhoc.meter_sap_by_document(meter, sap).count() == 1


def test_web_replays_add_nothing(spark, tmp_path):
    """Articles without a keyword too; a range without articles leaves no table."""
    from stationcast.plans import sentiment

    raw = spark.sql("""SELECT 1L AS _id, 'd' AS domain, 'http://a' AS source, 'good words' AS body, array('k') AS keywords,
        TIMESTAMP'2024-01-02 00:00:00' AS createdAt, TIMESTAMP'2024-01-02 00:00:00' AS updatedAt
        UNION ALL SELECT 2L, 'd', 'http://b', 'bad words', CAST(array() AS array<string>), TIMESTAMP'2024-01-02 00:00:00', TIMESTAMP'2024-01-02 00:00:00'""")
    path = str(tmp_path / "web")
    sentiment.web(spark, raw, path, "2023-01-01 00:00:00", "2023-02-01 00:00:00", "default.web_replayed")
    assert not spark.catalog.tableExists("default.web_replayed")
    for _ in range(3):
        sentiment.web(spark, raw, path, "2024-01-01 00:00:00", "2024-02-01 00:00:00", "default.web_replayed")
        assert spark.read.parquet(path).count() == 2 and spark.table("default.web_replayed").count() == 2


def test_medians_take_nan_as_missing(spark):
    from stationcast.operators.quantiles import exact_medians

    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", float("nan")), ("a", 3.0), ("b", float("nan"))], "k string, v double")
    assert sorted(tuple(r) for r in exact_medians(df, ["k"], {"v": "m"}).collect()) == [("a", 2.0), ("b", None)]
