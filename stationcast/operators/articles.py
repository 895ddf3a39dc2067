"""Tweets and web articles: frame-level steps over the text expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions import text as tx
from .joins import anti_trim
from .ordering import dedup_on, most_negative


def explode_keywords(df: DataFrame, column: str = "keywords") -> DataFrame:
    """One row per keyword; a row with no keyword stays with a null."""
    return df.withColumn(column, F.explode_outer(column))


def keyword_share(articles: DataFrame) -> DataFrame:
    """Articles per keyword, most first, and their share in percent; the total is a scalar subquery."""
    counts = articles.where(F.col("keywords").isNotNull()).groupBy("keywords").agg(
        F.count(F.lit(1)).alias("Total")
    )
    total = counts.agg(F.sum("Total")).scalar()
    return counts.withColumn("df_pct", F.bround(F.col("Total") / total, 2) * 100).orderBy(F.desc("Total"), "keywords")


def split_location(df: DataFrame, column: str = "location") -> DataFrame:
    """Place and country from a free-text location, UNKNOWN when missing."""
    country = F.coalesce(
        fx.shout(fx.token(column, ",", 1)), fx.shout(fx.token(column, " ", 1)), F.lit("UNKNOWN")
    )
    place = fx.shout(fx.token(fx.shout(fx.token(column, ",", 0)), " ", 0))
    return df.withColumns({"country": country, column: F.coalesce(place, F.lit("UNKNOWN"))})


def score_tweets(df: DataFrame, compat: bool = False) -> DataFrame:
    """Cleaned text, interactions and polarity of the raw text."""
    return df.withColumns({
        "df_tweet": tx.clean_tweet("tweet_text", compat),
        "longeractions": fx.row_sum("favorite_count", "retweets"),
        "sentiment": tx.polarity("tweet_text"),
    })


def score_articles(df: DataFrame, compat: bool = False) -> DataFrame:
    return df.withColumns({
        "analyzed_words": tx.clean_article("body", compat),
        "sentiment": tx.polarity("body"),
    })


def negative_report(df: DataFrame, n: int = 5) -> DataFrame:
    """Most negative articles first."""
    return most_negative(df.select("keywords", "domain", "sentiment", "body", "source"), n)


def new_articles(batch: DataFrame, gold: DataFrame, keys: tuple[str, str] = ("keywords", "source"), by: tuple[str, ...] = ("createdat",)) -> DataFrame:
    """Batch rows not yet in gold, one per key."""
    return anti_trim(dedup_on(batch, list(keys), list(by)), gold, list(keys))
