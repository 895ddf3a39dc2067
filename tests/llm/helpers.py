"""Small document tables with the awkward rows that every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, key string"


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def awkward(seed=1):
    """Nulls, empty and very long texts, repeated rows, ties, a hot source, columns that clash with results."""
    rng = random.Random(seed)
    base = words(rng, 300, 4000)
    texts = [words(rng, rng.randrange(5, 200), 5000) for _ in range(40)]
    near = base.split()
    rows = [(i, t, "en", "hot" if i % 3 else f"s{i % 7}") for i, t in enumerate(texts)]
    for i in range(12):
        part = list(near)
        for _ in range(i % 4 * 3):
            part[rng.randrange(len(part))] = f"x{rng.randrange(9999)}"
        rows.append((100 + i, " ".join(part), "de", "hot"))
    rows += [(200, None, "en", "hot"), (201, "", None, None), (202, " \n\t ", "fr", ""), (203, "one", "en", "s1"), (204, "One two", "en", "s1")]
    rows += [(205, "one two three é \U0001f600 <|endoftext|>  x", "en", "s1"), (206, words(rng, 30000, 50000), "en", "s2")]
    rows += [(None, base, "en", None), (None, base, "en", None), (None, "alone here now", None, "s3"), (7, texts[7], "en", "hot"), (7, "other text of seven", "en", "hot")]
    return [(i, t, lang, s, 0 if t is None else len(t), 5, 0.5, "k") for i, t, lang, s in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)


def empty(spark):
    return frame(spark, [])
