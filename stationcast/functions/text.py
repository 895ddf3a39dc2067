"""Text cleaning and polarity as narrow column expressions: no shuffle, no Python workers."""

from __future__ import annotations

import json
import zlib
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _c, words
from .lexicon import BOOSTERS, NEGATION_FACTOR, NEGATIONS, POLARITY, STOP_WORDS

# Own patterns of what the cleaning chains remove.
HANDLE = "@[\\p{L}\\p{N}_]*"
NOT_A_LETTER = "[^a-zA-Z#]"
LINK = "https?://\\S+"
LINK_TAIL = "(?s)https://.*"
LINK_LETTERS = "[htps:/]"
SIMPLE_NOISE = "(@[A-Za-z0-9]+)|([^0-9A-Za-z \\t])|(\\w+://\\S+)"


def strip_handles(col) -> Column:
    return F.regexp_replace(_c(col), HANDLE, "")


def keep_letters(col) -> Column:
    return F.regexp_replace(_c(col), NOT_A_LETTER, " ")


def strip_links(col, compat: str | None = None) -> Column:
    """Blank out links. ``compat="tweet"`` cuts at the first https link, ``compat="article"``
    blanks the characters h, t, p, s, ``:`` and ``/`` instead."""
    if compat == "tweet":
        return F.regexp_replace(_c(col), LINK_TAIL, "")
    if compat == "article":
        return F.regexp_replace(_c(col), LINK_LETTERS, " ")
    return F.regexp_replace(_c(col), LINK, " ")


def clean_simple(col) -> Column:
    """Handles, specials and links out in one pattern, runs of blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(col), SIMPLE_NOISE, " "), "\\s+", " "))


def remove_stopwords(tokens, stop=STOP_WORDS, compat: bool = False) -> Column:
    """Drop stop words; compat compares case-sensitively. A literal list becomes a hash set."""
    fold = (lambda w: w) if compat else F.lower
    return F.filter(_c(tokens), lambda w: ~fold(w).isin(list(stop)))


def longer_than(tokens, n: int) -> Column:
    return F.filter(_c(tokens), lambda w: F.length(w) > n)


def clean_tweet(col, compat: bool = False) -> Column:
    """Cleaned lower-case tweet text."""
    if compat:
        plain = strip_links(keep_letters(strip_handles(col)), compat="tweet")
        return F.lower(F.array_join(longer_than(remove_stopwords(words(plain), compat=True), 2), " "))
    # One split does the letter filter; one pass over the tokens drops stop words and short pieces.
    tokens = F.split(strip_handles(strip_links(col)), NOT_A_LETTER + "+")
    kept = F.filter(tokens, lambda w: (F.length(w) > 2) & ~F.lower(w).isin(list(STOP_WORDS)))
    return F.lower(F.array_join(kept, " "))


def clean_article(col, compat: bool = False) -> Column:
    """Long words of an article as a token array."""
    if compat:
        plain = strip_links(keep_letters(strip_handles(col)), compat="article")
        return longer_than(words(plain), 7)
    return longer_than(F.split(strip_handles(strip_links(col)), NOT_A_LETTER + "+"), 7)


def _lookup(table: dict[str, float], key: Column) -> Column:
    """The table's value for a token, null if it has none. A literal map is searched entry by entry, so a large table
    is an array of maps of about two words each, chosen by the token's CRC-32; it is one literal of the plan."""
    count = 1 << max(len(table) // 2 - 1, 0).bit_length()
    if count <= 4:
        return F.element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key)
    parts: list[dict[str, float]] = [{} for _ in range(count)]
    for word, value in table.items():
        parts[zlib.crc32(word.encode()) % count][word] = value
    maps = F.from_json(F.lit(json.dumps(parts)), "array<map<string,double>>")
    return F.element_at(F.get(maps, (F.crc32(key) % count).cast("int")), key)


def polarity(col, lexicon: dict[str, float] | None = None) -> Column:
    """Mean lexicon score of the raw text in [-1, 1], one digit, half-even.

    A booster right before a scored word scales it; a negation before the word (or before
    its booster) multiplies it by -0.5. No scored word gives 0.0, null text gives null.
    """
    table = POLARITY if lexicon is None else lexicon
    col = _c(col)

    def total(tokens: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: _lookup(table, F.get(tokens, i)).isNotNull())

        def score(i: Column) -> Column:
            gain = _lookup(BOOSTERS, F.get(tokens, i - 1))
            before = F.when(gain.isNull(), F.get(tokens, i - 1)).otherwise(F.get(tokens, i - 2))
            sign = F.when(before.isin(list(NEGATIONS)), F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
            raw = _lookup(table, F.get(tokens, i)) * F.coalesce(gain, F.lit(1.0)) * sign
            return F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw)) * 1000).cast("bigint")

        return F.aggregate(
            F.transform(spots, score),
            F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).alias("n")),
            lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")),
            lambda acc: F.when(acc["n"] > 0, acc["s"] / (acc["n"] * 1000)).otherwise(F.lit(0.0)),
        )

    # Scores are summed as whole thousandths, so the mean does not depend on the order of words.
    # Wrapping the token array binds it to a lambda variable, so the text is split only once.
    tokens = F.split(F.lower(col), "[^a-z]+")
    return F.when(col.isNotNull(), F.bround(F.get(F.transform(F.array(tokens), total), F.lit(0)), 1))
