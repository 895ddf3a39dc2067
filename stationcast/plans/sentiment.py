"""Tweets and web articles from the raw collections to their published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import articles as art
from ..operators.ordering import dedup, oldest
from ..operators.shaping import normalize_headers, stringify
from ..schemas import TWEETS_EXPORT, TWEETS_SENTIMENT, WEB_SENTIMENT
from ..sources.documents import docs_in_range, docs_of_day
from ..sources.layers import append_new, publish, publish_path, read_layer_or_none


def prepare_tweets(raw: DataFrame, n: int | None = None) -> DataFrame:
    """Date and time parts, full-row de-duplication; a limit keeps the n oldest."""
    df = raw.withColumns({
        "accout_creation": fx.date_part("accout_creation"),
        "tweet_time": fx.time_part("tweet_date"),
        "tweet_date": fx.date_part("tweet_date"),
    })
    df = dedup(df.drop("_id", "tweet_id"))
    return df if n is None else oldest(df, n, "tweet_date", "tweet_text")


def tweets_table(raw: DataFrame, n: int | None = None, compat: bool = False) -> DataFrame:
    """The 25-column tweet sentiment table."""
    scored = art.split_location(art.score_tweets(prepare_tweets(raw, n), compat))
    return stringify(scored, [("language", "tweet_language") if c == "tweet_language" else c for c in TWEETS_SENTIMENT])


def tweets(spark: SparkSession, raw: DataFrame, load_date: str, table: str = "default.tweets_sentiment") -> None:
    """One load date to the warehouse; replays add nothing."""
    day = docs_of_day(normalize_headers(raw, "lower"), load_date)
    publish(tweets_table(day), table, "append", ["author", "tweet_date", "tweet_time", "tweet_text", "load_date"])


def load_exported_tweets(df: DataFrame, table: str = "default.tweets_sentiment_export") -> None:
    """A pipe-separated export, already scored, to the warehouse."""
    text = normalize_headers(df, "lower")
    publish(stringify(text, TWEETS_EXPORT), table, "append", ["tweet_id"])


def web_batch(raw: DataFrame, start: str, end: str, compat: bool = False) -> DataFrame:
    """Scored articles, one row per keyword, of a createdAt range. Each text is scored once, before
    its keywords multiply the rows."""
    day = docs_in_range(raw, start, end)
    return normalize_headers(art.explode_keywords(art.score_articles(day, compat)), "lower")


def web_contract(batch: DataFrame) -> DataFrame:
    joined = batch.withColumn("analyzed_words", F.array_join("analyzed_words", ","))
    return stringify(joined, [("domain", "site") if c == "site" else c for c in WEB_SENTIMENT])


def web(
    spark: SparkSession, raw: DataFrame, gold_path: str, start: str, end: str, table: str = "default.web_sentiment"
) -> None:
    """New articles of the range appended to gold; the warehouse table is one over gold's files, so every
    text is cleaned, scored and written once. A run can simply be repeated.
    """
    batch = art.dedup_on(web_contract(web_batch(raw, start, end)), ["keywords", "source"], ["createdat"])
    append_new(batch, gold_path, ["keywords", "source"], "site")
    if read_layer_or_none(spark, gold_path) is not None:
        publish_path(spark, gold_path, table)
