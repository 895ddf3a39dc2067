"""Text cleaning, polarity, article flow and forecasts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from stationcast.functions import columns as fx
from stationcast.functions import text as tx
from stationcast.functions.lexicon import BOOSTERS, NEGATIONS, POLARITY, STOP_WORDS
from stationcast.operators import articles as art
from stationcast.operators import forecast as fc
from stationcast.operators import joins as jn
from stationcast.operators import ordering as od
from stationcast.plans import forecasts as plan
from stationcast.plans import sentiment as sent

from . import views as v
from .demand import DAILY_PRODUCT_SQL, RAW_SQL, SAP_DODO_SQL, daily_product, sap_dodo_features
from .registry import check
from .views import AUDIT_SQL, RUN, ctes


def _list(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# ---- text expressions -----------------------------------------------------------

_HANDLES = r"regexp_replace({x}, '@[\p{{L}}\p{{N}}_]*', '', 'g')"
_LETTERS = "regexp_replace({x}, '[^a-zA-Z#]', ' ', 'g')"
_LINKS = r"regexp_replace({x}, 'https?://\S+', ' ', 'g')"
_WORDS = r"list_filter(string_split_regex(trim({x}), '\s+'), lambda w: w <> '')"


def _sql(template, x):
    return template.format(x=x)


_PLAIN = _sql(_LETTERS, _sql(_HANDLES, _sql(_LINKS, "{x}")))


def _plain(x):
    return _sql(_LETTERS, _sql(_HANDLES, _sql(_LINKS, x)))


def _tweet_clean(x):
    words = _sql(_WORDS, _plain(x))
    return (f"lower(array_to_string(list_filter(list_filter({words}, lambda w: lower(w) NOT IN ({_list(STOP_WORDS)})), "
            f"lambda w: length(w) > 2), ' '))")


def _article_clean(x):
    return f"list_filter({_sql(_WORDS, _plain(x))}, lambda w: length(w) > 7)"


def _tweet_query(name, sql_expr, expr):
    check(name, f"{ctes('v_tweets')} SELECT tweet_id, {sql_expr} AS out FROM v_tweets")(
        lambda spark, sf: v.tweets(spark, sf).select("tweet_id", expr().alias("out"))
    )


_tweet_query("txt_strip_handles", _sql(_HANDLES, "tweet_text"), lambda: tx.strip_handles("tweet_text"))
_tweet_query("txt_keep_letters", _sql(_LETTERS, "tweet_text"), lambda: tx.keep_letters("tweet_text"))
_tweet_query("txt_strip_links", _sql(_LINKS, "tweet_text"), lambda: tx.strip_links("tweet_text"))
_tweet_query(
    "txt_clean_simple",
    r"trim(regexp_replace(regexp_replace(tweet_text, '(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\w+://\S+)', ' ', 'g'), '\s+', ' ', 'g'))",
    lambda: tx.clean_simple("tweet_text"),
)
_tweet_query(
    "txt_remove_stopwords",
    f"array_to_string(list_filter({_sql(_WORDS, _plain('tweet_text'))}, lambda w: lower(w) NOT IN ({_list(STOP_WORDS)})), ' ')",
    lambda: F.array_join(tx.remove_stopwords(fx.words(tx.keep_letters(tx.strip_handles(tx.strip_links("tweet_text"))))), " "),
)
_tweet_query(
    "txt_min_length",
    f"array_to_string(list_filter({_sql(_WORDS, _plain('tweet_text'))}, lambda w: length(w) > 2), ' ')",
    lambda: F.array_join(tx.longer_than(fx.words(tx.keep_letters(tx.strip_handles(tx.strip_links("tweet_text")))), 2), " "),
)
_tweet_query("txt_clean_tweet", _tweet_clean("tweet_text"), lambda: tx.clean_tweet("tweet_text"))
check("txt_clean_article", f"{ctes('v_articles')} SELECT _id, array_to_string({_article_clean('body')}, ' ') AS analyzed_words FROM v_articles")(
    lambda spark, sf: v.articles(spark, sf).select("_id", F.array_join(tx.clean_article("body"), " ").alias("analyzed_words"))
)


def _values(table):
    return ", ".join(f"('{k}', CAST({x} AS DOUBLE))" for k, x in table.items())


def _polarity_sql(source, key, text):
    """Polarity by token positions and joins, independent of the in-row formulation."""
    return rf"""lex(w, s) AS (VALUES {_values(POLARITY)}), boost(b, g) AS (VALUES {_values(BOOSTERS)}),
toks AS (SELECT {key} AS k, string_split_regex(trim(regexp_replace(lower({text}), '[^a-z]+', ' ', 'g')), '\s+') AS ws FROM {source}),
pos AS (SELECT k, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS p1, CASE WHEN i > 2 THEN ws[i - 2] END AS p2 FROM toks, unnest(range(1, len(ws) + 1)) AS u(i)),
hit AS (SELECT k, CAST(round(1000 * greatest(-1.0, least(1.0, s * coalesce(g, 1.0) * CASE WHEN (CASE WHEN g IS NULL THEN p1 ELSE p2 END) IN ({_list(NEGATIONS)}) THEN -0.5 ELSE 1.0 END))) AS BIGINT) AS v
  FROM pos JOIN lex USING (w) LEFT JOIN boost ON p1 = b),
pol AS (SELECT k, sum(v)::DOUBLE / (1000 * count(*)) AS p FROM hit GROUP BY k)"""


check("txt_polarity", f"""{ctes('v_tweets')}, {_polarity_sql('v_tweets', 'tweet_id', 'tweet_text')}
SELECT tweet_id, CASE WHEN tweet_text IS NOT NULL THEN round_even(coalesce(p, 0.0), 1) + 0.0 END AS sentiment FROM v_tweets LEFT JOIN pol ON tweet_id = k""")(
    lambda spark, sf: v.tweets(spark, sf).select("tweet_id", tx.polarity("tweet_text").alias("sentiment"))
)
_PLACE = """upper(coalesce(trim(string_split(upper(trim(string_split(location, ',')[1])), ' ')[1]), 'UNKNOWN')) AS location,
coalesce(upper(trim(string_split(location, ',')[2])), upper(trim(string_split(location, ' ')[2])), 'UNKNOWN') AS country"""
check("txt_location_country", f"{ctes('v_tweets')} SELECT tweet_id, {_PLACE} FROM v_tweets")(
    lambda spark, sf: art.split_location(v.tweets(spark, sf)).select("tweet_id", "location", "country")
)

# ---- articles ----------------------------------------------------------------------

_EXPLODED = """v_kw AS (SELECT * EXCLUDE (keywords), unnest(CASE WHEN len(keywords) = 0 THEN [NULL] ELSE keywords END) AS keywords FROM v_articles)"""
check("gen_explode_keywords", f"{ctes('v_articles')}, {_EXPLODED} SELECT _id, domain, source, keywords FROM v_kw")(
    lambda spark, sf: art.explode_keywords(v.articles(spark, sf)).select("_id", "domain", "source", "keywords")
)
check("agg_keyword_share", f"""{ctes('v_articles')}, {_EXPLODED}, n AS (SELECT keywords, count(*) AS Total FROM v_kw WHERE keywords IS NOT NULL GROUP BY 1)
SELECT keywords, Total, round(round_even(Total / (SELECT sum(Total) FROM n), 2) * 100, 6) AS df_pct FROM n""")(
    lambda spark, sf: art.keyword_share(art.explode_keywords(v.articles(spark, sf))).withColumn("df_pct", F.round("df_pct", 6))
)


def _scored(spark, sf):
    return art.explode_keywords(art.score_articles(v.articles(spark, sf)))


_SCORED = f"""{ctes('v_articles')}, {_EXPLODED}, {_polarity_sql('v_articles', '_id', 'body')},
v_scored AS (SELECT v_kw.*, {_article_clean('body')} AS analyzed_words, round_even(coalesce(p, 0.0), 1) + 0.0 AS sentiment FROM v_kw LEFT JOIN pol ON _id = k)"""
check("flt_negative_sentiment", f"{_SCORED} SELECT _id, keywords, sentiment FROM v_scored WHERE sentiment < 0")(
    lambda spark, sf: _scored(spark, sf).where(F.col("sentiment") < 0).select("_id", "keywords", "sentiment")
)
check("agg_negative_count", f"{_SCORED} SELECT count(*) AS negative_rows FROM v_scored WHERE sentiment < 0")(
    lambda spark, sf: od.negative_count(_scored(spark, sf))
)
_REPORT = f"{_SCORED} SELECT keywords, domain, sentiment, body, source FROM v_scored WHERE sentiment < 0 ORDER BY sentiment, source NULLS FIRST, keywords NULLS FIRST, body LIMIT 5"
check("srt_most_negative", f"{_SCORED} SELECT sentiment, source, keywords FROM v_scored WHERE sentiment < 0 ORDER BY sentiment, source NULLS FIRST, keywords NULLS FIRST LIMIT 5")(
    lambda spark, sf: od.most_negative(_scored(spark, sf)).select("sentiment", "source", "keywords")
)
check("txt_negative_report", _REPORT)(
    lambda spark, sf: od.most_negative(_scored(spark, sf).select("keywords", "domain", "sentiment", "body", "source"), 5, ("source", "keywords", "body"))
)
_FIRST = """SELECT keywords, source, _id, domain FROM (SELECT *, row_number() OVER (PARTITION BY keywords, source ORDER BY _id) AS r FROM v_kw) WHERE r = 1"""
check("set_dedup_keys", f"{ctes('v_articles')}, {_EXPLODED} {_FIRST}")(
    lambda spark, sf: od.dedup_on(
        art.explode_keywords(v.articles(spark, sf)).select("keywords", "source", "_id", "domain"), ["keywords", "source"], ["_id"])
)


def _gold_side(spark, sf):
    """Rows already published: one keyword of every article, keys padded with blanks."""
    return v.articles(spark, sf).select(
        F.concat(F.lit(" "), F.get("keywords", F.lit(1)), F.lit(" ")).alias("keywords"),
        F.concat(F.col("source"), F.lit("  ")).alias("source")).where("keywords IS NOT NULL")


_GOLD = "v_gold AS (SELECT ' ' || keywords[2] || ' ' AS keywords, source || '  ' AS source FROM v_articles WHERE len(keywords) = 2)"
check("jn_anti_trim_2", f"""{ctes('v_articles')}, {_EXPLODED}, {_GOLD} SELECT _id, keywords, source FROM v_kw n
WHERE NOT EXISTS (SELECT 1 FROM v_gold g WHERE trim(g.source) = trim(n.source) AND trim(g.keywords) = trim(n.keywords))""")(
    lambda spark, sf: jn.anti_trim(
        art.explode_keywords(v.articles(spark, sf)).select("_id", "keywords", "source"), _gold_side(spark, sf), ["keywords", "source"])
)
check("txt_incremental_dedup", f"""{ctes('v_articles')}, {_EXPLODED}, {_GOLD}, v_first AS ({_FIRST}) SELECT keywords, source, _id, domain FROM v_first n
WHERE NOT EXISTS (SELECT 1 FROM v_gold g WHERE trim(g.source) = trim(n.source) AND trim(g.keywords) = trim(n.keywords))""")(
    lambda spark, sf: art.new_articles(
        art.explode_keywords(v.articles(spark, sf)).select("keywords", "source", "_id", "domain"), _gold_side(spark, sf), by=("_id",))
)

_TWEET_TABLE = f"""{ctes('v_tweets')}, {_polarity_sql('v_tweets', 'tweet_id', 'tweet_text')}
SELECT author, left(tweet_date, 10) AS tweet_date, CAST(follower_count AS VARCHAR) AS follower_count, CAST(friends_count AS VARCHAR) AS friends_count,
account_verified, CAST(favorite_count AS VARCHAR) AS favorite_count, left(accout_creation, 10) AS accout_creation, CAST(retweets AS VARCHAR) AS retweets,
tweet_text, userdesc, device, timezone, language AS tweet_language, following, follow_request_sent, profile, CAST(statuses_count AS VARCHAR) AS statuses_count,
{_PLACE}, filter_col, right(tweet_date, 8) AS tweet_time, {_tweet_clean('tweet_text')} AS df_tweet,
CAST(coalesce(favorite_count, 0) + coalesce(retweets, 0) AS VARCHAR) AS longeractions, CAST((round_even(coalesce(p, 0.0), 1) + 0.0) AS VARCHAR) AS sentiment, load_date
FROM v_tweets LEFT JOIN pol ON tweet_id = k"""
TWEET_TABLE = _TWEET_TABLE
check("flow_tweets", f"SELECT DISTINCT * FROM ({_TWEET_TABLE})")(lambda spark, sf: sent.tweets_table(v.tweets(spark, sf)))


_WEB = f"""{_SCORED}, web AS (SELECT keywords, domain AS site, source, strftime(createdAt, '%Y-%m-%d %H:%M:%S') AS createdat, strftime(updatedAt, '%Y-%m-%d %H:%M:%S') AS updatedat,
strftime(createdAt, '%Y-%m-%d') AS created_date, array_to_string(analyzed_words, ',') AS analyzed_words, CAST(sentiment AS VARCHAR) AS sentiment FROM v_scored),
pick AS (SELECT *, row_number() OVER (PARTITION BY keywords, source ORDER BY createdat, site, updatedat, created_date, analyzed_words, sentiment) AS r FROM web)"""
WEB_SQL = f"{_WEB} SELECT keywords, source, site FROM pick WHERE r = 1"


@check("flow_web", f"{_WEB} SELECT * EXCLUDE (r) FROM pick WHERE r = 1")
def _(spark, sf):
    batch = sent.web_batch(v.articles(spark, sf), "2024-01-01 00:00:00", "2025-01-01 00:00:00")
    return od.dedup_on(sent.web_contract(batch), ["keywords", "source"], ["createdat"])


# ---- forecasts ----------------------------------------------------------------------

_STATION = "replace(DELIVERY_STATION, '''', '')"
_SERIES = {
    "orders": f"{SAP_DODO_SQL}, pts AS (SELECT {_STATION} AS station, SALES_DATE AS ds, avg(QUANTITY_ORDERED) AS y, count(QUANTITY_ORDERED) AS w FROM v_flag WHERE SALES_DATE IS NOT NULL AND DELIVERY_DATE IS NOT NULL AND DELIVERY_STATION IS NOT NULL GROUP BY 1, 2)",
    "delays": f"{SAP_DODO_SQL}, pts AS (SELECT {_STATION} AS station, DELIVERY_DATE AS ds, avg(DELIVERY_DAYS) AS y, count(DELIVERY_DAYS) AS w FROM v_flag WHERE DELIVERY_DAYS IS NOT NULL AND DELIVERY_DATE IS NOT NULL AND DELIVERY_STATION IS NOT NULL GROUP BY 1, 2)",
}
for _name, _y in (("sales", "TOTAL_VOLUME_SOLD"), ("quantity", "QUANTITY"), ("next_delivery", "NEXT_DELIVERY_DAYS")):
    _SERIES[_name] = f"{RAW_SQL}, dsp AS ({DAILY_PRODUCT_SQL}), pts AS (SELECT STATION AS station, SALES_DATE AS ds, avg({_y}) AS y, count({_y}) AS w FROM dsp WHERE SALES_DATE IS NOT NULL AND STATION IS NOT NULL GROUP BY 1, 2)"


def _features(spark, sf, name):
    return sap_dodo_features(spark, sf) if name in ("orders", "delays") else daily_product(spark, sf)


def _points(spark, sf, name):
    return plan.target_points(_features(spark, sf, name), name)


def _register_series(name):
    check(f"fct_series_{name}", f"{_SERIES[name]} SELECT station, ds, round(y, 7) AS y, w FROM pts")(
        lambda spark, sf: _points(spark, sf, name).withColumn("y", F.round("y", 7))
    )
    t, day = plan.TARGETS[name], "%Y%m%d" if plan.TARGETS[name].date_format == "yyyyMMdd" else "%Y-%m-%d"

    # no SQL: tests/test_forecast.py holds the fit against a second one in plain numpy
    @check(f"flow_forecast_{name}")
    def values(spark, sf):
        """Forecast and bounds of every day of a station with two points or more, and the seven days after."""
        fitted = fc.forecast(_points(spark, sf, name)).withColumns({c: F.round(c, 3) for c in ("yhat", "yhat_lower", "yhat_upper", "y")})
        return fc.publish_names(fitted, replace(t, interval=True))

    def flow(spark, sf):
        """The days and actuals of the published table."""
        table = plan.model_table(_features(spark, sf, name), name)
        low, high = (F.col(f"{end}_{t.forecast_name}") if t.interval else F.col(t.forecast_name) for end in ("LOWER", "UPPER"))
        fits = F.col(t.forecast_name).between(low, high) & ~F.isnan(t.forecast_name)
        return table.select(t.key, t.date_name, F.round(t.actual_name, 7).alias(t.actual_name), F.coalesce(fits, F.lit(False)).alias("has_forecast"))

    check(f"flow_forecast_{name}_days", f"""{_SERIES[name]}, fit AS (SELECT station, max(ds) AS d FROM pts GROUP BY 1 HAVING count(y) >= 2),
days AS (SELECT station, ds, y FROM pts SEMI JOIN fit USING (station) UNION ALL SELECT station, CAST(d + CAST(i AS INTEGER) AS DATE), NULL FROM fit, range(1, 8) AS u(i))
SELECT station AS {t.key}, strftime(ds, '{day}') AS {t.date_name}, round(y, 7) AS {t.actual_name}, true AS has_forecast FROM days""")(flow)


for _name in _SERIES:
    _register_series(_name)

_BASE = f"""{_SERIES['sales']}, known AS (SELECT * FROM pts WHERE y IS NOT NULL), t0 AS (SELECT station, min(ds) AS d0 FROM known GROUP BY 1),
fit AS (SELECT k.*, CAST(ds - d0 AS DOUBLE) AS x, d0 FROM known k JOIN t0 USING (station)),
trend AS (SELECT station, any_value(d0) AS d0, coalesce(regr_slope(y, x), 0) AS b, coalesce(regr_intercept(y, x), 0) AS a, count(y) AS n FROM fit GROUP BY 1 HAVING count(y) >= 2),
rest AS (SELECT f.station, f.ds, y - (a + b * x) AS r FROM fit f JOIN trend t USING (station)),
week AS (SELECT station, dayofweek(ds) AS dow, avg(r) AS s FROM rest GROUP BY 1, 2),
sd AS (SELECT r.station, coalesce(stddev_pop(r.r - w.s), 0) AS sd FROM rest r JOIN week w ON r.station = w.station AND dayofweek(r.ds) = w.dow GROUP BY 1),
grid AS (SELECT station, ds FROM pts UNION ALL SELECT station, CAST(max(ds) + CAST(i AS INTEGER) AS DATE) FROM pts, range(1, 8) AS u(i) GROUP BY station, i),
base AS (SELECT g.station, g.ds, a + b * CAST(g.ds - d0 AS DOUBLE) + coalesce(s, 0) AS yhat, sd FROM grid g JOIN trend USING (station) JOIN sd USING (station)
  LEFT JOIN week w ON g.station = w.station AND dayofweek(g.ds) = w.dow)"""


def _base(spark, sf, name="sales"):
    return fc.baseline(_points(spark, sf, name))


check("fct_horizon", f"{_BASE} SELECT * FROM grid")(lambda spark, sf: fc.horizon(_points(spark, sf, "sales")))
check("fct_baseline_sql", f"{_BASE} SELECT station, ds, round(yhat, 3) AS yhat FROM base")(
    lambda spark, sf: _base(spark, sf).select("station", "ds", F.round("yhat", 3).alias("yhat"))
)
check("fct_interval", f"{_BASE} SELECT station, ds, round(yhat - 1.96 * sd, 3) AS yhat_lower, round(yhat + 1.96 * sd, 3) AS yhat_upper FROM base")(
    lambda spark, sf: _base(spark, sf).select("station", "ds", F.round("yhat_lower", 3).alias("yhat_lower"), F.round("yhat_upper", 3).alias("yhat_upper"))
)
_LINE = "5 + 0.25 * CAST(ds - DATE '1995-01-01' AS DOUBLE) + CAST(substr(station, 4) AS DOUBLE)"


@check("fct_line_fit", f"""{ctes('v_meter')}, days AS (SELECT DISTINCT STATION AS station, SALES_DATE AS ds FROM v_meter),
far AS (SELECT * FROM days UNION ALL SELECT station, CAST(max(ds) + CAST(i AS INTEGER) AS DATE) FROM days, range(1, 8) AS u(i) GROUP BY station, i)
SELECT station, ds, round({_LINE}, 2) AS yhat FROM far""")
def _(spark, sf):
    """Stations whose values lie on a line: the fit and its horizon are that line."""
    days = v.meter(spark, sf).select(F.col("STATION").alias("station"), F.col("SALES_DATE").alias("ds")).distinct()
    line = 5 + 0.25 * F.datediff("ds", F.lit("1995-01-01")) + F.substring("station", 4, 9).cast("double")
    fitted = fc.forecast(days.withColumns({"y": line, "w": F.lit(1).cast("long")}))
    return fitted.select("station", "ds", F.round("yhat", 2).alias("yhat"))


@check("fct_fit_predict")
def _(spark, sf):
    """Forecast and interval of the sales series; tested against a second fit in plain numpy."""
    fitted = fc.forecast(_points(spark, sf, "sales"))
    return fitted.withColumns({c: F.round(c, 3) for c in ("yhat", "yhat_lower", "yhat_upper", "y")})


@check("fct_holdout")
def _(spark, sf):
    """Each station's last seven days, forecast from the days before."""
    return fc.holdout(_points(spark, sf, "sales"))


@check("fct_isolate_failures", """WITH pts AS (SELECT 'C' || o_custkey AS station, CAST(o_orderdate AS DATE) AS ds,
max(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END) AS y FROM orders GROUP BY 1, 2)
SELECT station, CASE WHEN count(y) >= 2 THEN count(*) + 7 ELSE 1 END AS n, count(y) < 2 AS failed FROM pts GROUP BY 1""")
def _(spark, sf):
    """Customers as stations: many have one usable day or none, and only those fail."""
    orders = v.table(spark, sf, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("station"), F.to_date("o_orderdate").alias("ds"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("v"))
    points = orders.groupBy("station", "ds").agg(F.max("v").alias("y"), F.count("v").alias("w"))
    report = fc.forecast(points, on_error="report")
    return report.groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("fit_error").isNotNull()).alias("failed"))


check("fct_attach_actuals", f"{_BASE} SELECT b.station, b.ds, round(y, 7) AS y FROM base b LEFT JOIN pts p ON p.station = b.station AND p.ds = b.ds")(
    lambda spark, sf: fc.attach_actuals(_base(spark, sf), _points(spark, sf, "sales")).select("station", "ds", F.round("y", 7).alias("y"))
)
check("jn_forecast_actuals", f"{_BASE} SELECT b.station, b.ds, round(y, 7) AS y FROM base b JOIN pts p ON p.station = b.station AND p.ds = b.ds")(
    lambda spark, sf: fc.attach_actuals(_base(spark, sf), _points(spark, sf, "sales"), "inner").select("station", "ds", F.round("y", 7).alias("y"))
)
check("fct_rename_publish", f"""{_BASE} SELECT strftime(b.ds, '%Y-%m-%d') AS FORECASTED_SALES_DATE, round(yhat, 3) AS FORCASTED_DAILY_SALES_VOLUME, b.station AS STATION, round(y, 7) AS ACTUAL_VOLUME_SOLD
FROM base b LEFT JOIN pts p ON p.station = b.station AND p.ds = b.ds""")(
    lambda spark, sf: fc.publish_names(fc.attach_actuals(_base(spark, sf), _points(spark, sf, "sales")), fc.SALES).withColumns(
        {"FORCASTED_DAILY_SALES_VOLUME": F.round("FORCASTED_DAILY_SALES_VOLUME", 3), "ACTUAL_VOLUME_SOLD": F.round("ACTUAL_VOLUME_SOLD", 7)})
)


# The combine steps are checked on model tables built from plain aggregates of the feeds.
def _model(spark, sf, fold, column, target):
    """A model table whose actual is a daily aggregate and whose forecast is a quarter above it."""
    points = v.meter(spark, sf).groupBy(F.col("STATION").alias("station"), F.col("SALES_DATE").alias("ds")).agg(
        fold(column).cast("double").alias("y"))
    return fc.publish_names(points.withColumns({
        "yhat": F.col("y") + 0.25, "yhat_lower": F.col("y"), "yhat_upper": F.col("y")}), target)


def _m_sql(y):
    return f"SELECT STATION, SALES_DATE, CAST({y} AS DOUBLE) AS y FROM v_meter GROUP BY 1, 2"


_SAP_MERGE = f"""{ctes('v_meter')}, d AS ({_m_sql('max(VOLUME)')}), o AS ({_m_sql('max(CURRENT_READING)')}),
mrg AS (SELECT strftime(SALES_DATE, '%Y%m%d') AS FORECASTED_DATE, STATION AS DELIVERY_STATION, round(d.y + 0.25, 0) AS FORCASTED_DELIVERY_DAYS, d.y AS ACTUAL_DELIVERY_DAYS,
o.y + 0.25 AS FORCASTED_ORDER, o.y AS ACTUAL_ORDER FROM d JOIN o USING (STATION, SALES_DATE))"""


SAP_MERGE = _SAP_MERGE


def sap_models(spark, sf):
    return _model(spark, sf, F.max, "VOLUME", fc.DELAYS), _model(spark, sf, F.max, "CURRENT_READING", fc.ORDERS)


def _combined_sap(spark, sf):
    return fc.combine_sap(*sap_models(spark, sf), RUN)


check("fct_combine_sap", f"{_SAP_MERGE} SELECT *, {AUDIT_SQL} FROM mrg")(
    _combined_sap
)
check("jn_forecast_merge_2", f"{_SAP_MERGE} SELECT FORECASTED_DATE, DELIVERY_STATION, ACTUAL_DELIVERY_DAYS, ACTUAL_ORDER FROM mrg")(
    lambda spark, sf: _combined_sap(spark, sf).select("FORECASTED_DATE", "DELIVERY_STATION", "ACTUAL_DELIVERY_DAYS", "ACTUAL_ORDER")
)
_CODO_MERGE = f"""{ctes('v_meter')}, g AS ({_m_sql('max(VOLUME)')}), s AS ({_m_sql('sum(VOLUME)')}), q AS ({_m_sql('max(CURRENT_READING)')}),
mrg AS (SELECT STATION, SALES_DATE, strftime(SALES_DATE, '%Y-%m-%d') AS FORECASTED_SALES_DATE, round(g.y + 0.25, 0) AS FORCASTED_NEXT_DELIVERY_DAYS, g.y AS ACTUAL_NEXT_DELIVERY_DAYS,
round(s.y + 0.25, 0) AS FORCASTED_DAILY_SALES_VOLUME, s.y AS ACTUAL_VOLUME_SOLD, q.y + 0.25 AS FORECASTED_QUANTITY, q.y AS ACTUAL_QUANTITY
FROM g JOIN s USING (STATION, SALES_DATE) JOIN q USING (STATION, SALES_DATE)),
fin AS (SELECT * EXCLUDE (SALES_DATE), strftime(SALES_DATE + CAST(round(ACTUAL_QUANTITY * 0.5 / nullif(FORCASTED_DAILY_SALES_VOLUME, 0), 0) AS INTEGER), '%Y-%m-%d') AS NEXT_OPTIMAL_ORDER_DATE,
'Your order likely to take: ' || CAST(FORCASTED_NEXT_DELIVERY_DAYS AS BIGINT) || ' days' AS NEXT_OPTIMAL_ORDER_DATE_REASON FROM mrg)"""


CODO_MERGE = _CODO_MERGE


def codo_models(spark, sf):
    return (_model(spark, sf, F.max, "VOLUME", fc.NEXT_DELIVERY),
            _model(spark, sf, F.sum, "VOLUME", fc.SALES),
            _model(spark, sf, F.max, "CURRENT_READING", fc.QUANTITY))


def _combined_codo(spark, sf):
    return fc.combine_codo(*codo_models(spark, sf), RUN)


check("fct_combine_codo", f"{_CODO_MERGE} SELECT *, {AUDIT_SQL} FROM fin")(_combined_codo)
check("jn_forecast_merge_3", f"{_CODO_MERGE} SELECT STATION, FORECASTED_SALES_DATE, ACTUAL_NEXT_DELIVERY_DAYS, ACTUAL_VOLUME_SOLD, ACTUAL_QUANTITY FROM mrg")(
    lambda spark, sf: fc.merge_codo(*codo_models(spark, sf)).select("STATION", "FORECASTED_SALES_DATE", "ACTUAL_NEXT_DELIVERY_DAYS", "ACTUAL_VOLUME_SOLD", "ACTUAL_QUANTITY")
)
check("fct_next_order_date", f"{_CODO_MERGE} SELECT STATION, FORECASTED_SALES_DATE, NEXT_OPTIMAL_ORDER_DATE FROM fin")(
    lambda spark, sf: _combined_codo(spark, sf).select("STATION", "FORECASTED_SALES_DATE", "NEXT_OPTIMAL_ORDER_DATE")
)
check("fct_reason_text", f"{_CODO_MERGE} SELECT STATION, FORECASTED_SALES_DATE, NEXT_OPTIMAL_ORDER_DATE_REASON FROM fin")(
    lambda spark, sf: _combined_codo(spark, sf).select("STATION", "FORECASTED_SALES_DATE", "NEXT_OPTIMAL_ORDER_DATE_REASON")
)
