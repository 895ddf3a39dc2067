import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationcast.functions import columns as fx
from stationcast.functions import text as tx
from stationcast.operators import articles as art


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,want", [
    ("It is very good", 0.9), ("not good", -0.4), ("not very good", -0.5), ("plain words", 0.0), (None, None), ("", 0.0),
    ("good bad", 0.0), ("extremely horrible", -1.0), ("goodness no", 0.0), ("GOOD, not: bad!", 0.5),
])
def test_polarity(spark, text, want):
    assert one(spark, text, tx.polarity("t")) == want


def _scored(text, lexicon):
    """Polarity by the contract, one word after another."""
    from stationcast.functions.lexicon import BOOSTERS, NEGATION_FACTOR, NEGATIONS

    tokens, scores = re.split("[^a-z]+", text.lower()), []
    for i, w in enumerate(tokens):
        if w in lexicon:
            before = tokens[i - 1] if i else None
            gain = BOOSTERS.get(before)
            if gain is not None:
                before = tokens[i - 2] if i > 1 else None
            raw = lexicon[w] * (1.0 if gain is None else gain) * (NEGATION_FACTOR if before in NEGATIONS else 1.0)
            scores.append(round(max(-1.0, min(1.0, raw)) * 1000 + 1e-9))
    return sum(scores) / (len(scores) * 1000) if scores else 0.0


def _lexicon(n):
    letters = "abcdefghij"
    return {"w" + "".join(letters[int(d)] for d in str(i)): round((i * 37 % 21 - 10) / 10, 1) for i in range(n)}


@pytest.mark.parametrize("n", [1, 2, 7, 50, 5000])
def test_polarity_of_any_lexicon(spark, n):
    lexicon, rng = _lexicon(n), random.Random(n)
    words = [*list(lexicon)[:200], "not", "very", "plain", "never", "so", ""]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.polarity("t", lexicon).alias("p"))
    for r in df.collect():
        assert abs(r.p - _scored(r.t, lexicon)) <= 0.0501, r.t


def test_lookup_time_does_not_grow_with_the_lexicon(spark):
    import time

    words = list(_lexicon(50))
    df = spark.range(0, 40000, 1, 4).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.hash("id", i), F.lit(50)) + 1).cast("int"))), " ").alias("t")).cache()
    df.count()
    took = {}
    for n in (50, 5000) * 3:
        began = time.time()
        df.select(tx.polarity("t", _lexicon(n)).alias("p")).write.format("noop").mode("overwrite").save()
        took.setdefault(n, []).append(time.time() - began)
    df.unpersist()
    assert min(took[5000]) < 3 * min(took[50]) + 1


def test_links_are_removed_before_letters(spark):
    text = "Fuel queue https://t.co/AbCdE and http://x.example/path today"
    assert one(spark, text, tx.clean_tweet("t")) == "fuel queue today"
    assert "https" in one(spark, text, tx.clean_tweet("t", compat=True))


def test_article_letters_survive(spark):
    text = "perspectives throughout"
    assert one(spark, text, tx.clean_article("t")) == ["perspectives", "throughout"]
    assert one(spark, text, tx.clean_article("t", compat=True)) == []


def test_stop_words_ignore_case(spark):
    assert one(spark, "The station and Those pumps", tx.clean_tweet("t")) == "station pumps"
    assert one(spark, "The station and Those pumps", tx.clean_tweet("t", compat=True)) == "the station those pumps"


def test_handles_do_not_eat_longer_ones(spark):
    assert one(spark, "@a hello @abc @ there @josé!", tx.strip_handles("t")) == " hello   there !"


def test_whole_text_is_read(spark):
    assert one(spark, "word " * 20000 + "excellent", tx.polarity("t")) == 1.0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(max_size=60))
def test_cleaning_is_idempotent(spark, text):
    once = one(spark, text, tx.clean_tweet("t"))
    assert one(spark, once, tx.clean_tweet("t")) == once


@pytest.mark.parametrize("place,want", [
    ("Lagos, Nigeria", ("LAGOS", "NIGERIA")), ("Abuja Nigeria", ("ABUJA", "NIGERIA")), ("Kano", ("KANO", "UNKNOWN")),
    (None, ("UNKNOWN", "UNKNOWN")), ("Port Harcourt, Rivers", ("PORT", "RIVERS")),
])
def test_location(spark, place, want):
    df = spark.createDataFrame([(place,)], "location string")
    assert tuple(art.split_location(df).select("location", "country").first()) == want


def test_tolerant_scalars(spark):
    df = spark.createDataFrame([("45,000", "05/01/2023 7:05", "x"), ("", "bad", None)], "q string, d string, z string")
    got = df.select(
        fx.clean_double("q"), fx.created_text("d"), fx.parse_date("d", fx.FEED_STAMP).cast("string"),
        fx.token("z", " ", 3), fx.clean_int("z"), fx.safe_div(F.lit(1.0), F.lit(0.0)), fx.unless_sentinel(F.lit(-9999.0)),
        fx.days(F.lit("2023-01-02").cast("date"), F.lit("2023-01-01").cast("date")), fx.pad_time(F.lit("7:05")),
        fx.round_half_even(F.lit(0.25), 1), fx.round_half_up(F.lit(2.5)), fx.month_key(F.lit("2023-04-09").cast("date")),
    ).collect()
    assert tuple(got[0]) == (45000.0, "2023-01-05 07:05", "2023-01-05", None, None, None, None, None, "07:05", 0.2, 3.0, 202304)
    assert tuple(got[1])[:3] == (None, None, None)
