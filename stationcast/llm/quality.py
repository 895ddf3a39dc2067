"""Quality rules whose cut-offs follow each language and source.

Every whole text is measured once in its row. Fixed base rules reject what is no prose anywhere (too few words, or
mostly repeated three-word windows). For the rest, mergeable quantile sketches of five ratios are built per
(language, source): counts of the ratio's value in steps of 1 / `STEPS`, the same whatever the order and the tasks, that merge
by adding. A ratio passes if it lies within [q25 - reach * spread, q75 + reach * spread], where the
spread is the quartile distance, at least the documented `least` of that ratio. A group with fewer than `few`
documents takes the merged sketch of its language, and that of all documents where the language has too few as
well. The cut-offs are a table with one row per group, joined to the documents. Quartiles are exact to half a step;
values of `TOP` and more count as one.

Defined results: a null or empty text has no words and fails the base rules; null language or source is a value of
its own; equal texts of a group get equal verdicts; a ratio equal to a cut-off passes; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Ratio -> (least spread, side that is tested: both, or high values only).
RATIOS = {
    "symbol_rate": (0.05, "high"), "word_length": (0.5, "both"), "dup_line_rate": (0.2, "high"),
    "repeat_rate": (0.15, "high"), "upper_rate": (0.05, "high"),
}
REACH = 3.0
FEW = 100
#: Steps of the sketches for a ratio of one, and the ratio at which they end: a sketch has at most their product of counts.
STEPS, TOP = 1024, 1024

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def repeated_words(words: list) -> int:
    """Words that lie in a three-word window found twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, total, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(end, i)
            end = i + 3
    return total


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one text. Splitting UTF-8 bytes at ASCII white space gives exactly the contract's words."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper = sum(map(data.count, _CAPITALS))
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), upper,
    )


_CAPITALS = [bytes([c]) for c in range(65, 91)]


def measured(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """`keep` and MEASURES (long) of each row, the latter with the prefix."""
    names = [prefix + m for m in MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t) for t in batch.column(len(keep)).to_pylist()]
            columns = zip(*found) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *(pa.array(c, pa.int64()) for c in columns)], [*keep, *names]
            )

    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    kept = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(rows, run, ", ".join([*kept, *(f"`{n}` long" for n in names)]))


def ratios(prefix: str = "") -> dict[str, Column]:
    c = lambda name: F.col(prefix + name).cast("double")
    words, lines, chars = (F.nullif(c(name), F.lit(0.0)) for name in ("n_words", "n_lines", "word_chars"))
    found = {
        "symbol_rate": c("n_symbols") / words, "word_length": c("word_chars") / words, "dup_line_rate": c("n_dup_lines") / lines,
        "repeat_rate": c("n_repeat_words") / words, "upper_rate": c("n_upper") / chars,
    }
    return {k: F.coalesce(v, F.lit(0.0)) for k, v in found.items()}


def base_failed(prefix: str = "") -> Column:
    few, words, repeats = F.lit(MIN_WORDS), F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < few) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def cut_offs(rows: DataFrame, prefix: str = "", few: int = FEW, reach: float = REACH) -> DataFrame:
    """lang, source and an array of (low, high) per ratio, from the measured rows that pass the base rules."""
    good = rows.filter(~base_failed(prefix)).select("lang", "source", F.posexplode(F.array(*ratios(prefix).values())).alias("k", "v"))
    step = F.least(F.floor(F.col("v") * STEPS), F.lit(STEPS * TOP)).cast("long").alias("step")
    sketches = written(good.groupBy("lang", "source", "k", step).agg(F.count(F.lit(1)).alias("n")), "quality-sketches")
    least = F.array(*[F.lit(x) for x, _ in RATIOS.values()])
    both = F.array(*[F.lit(side == "both") for _, side in RATIOS.values()])

    def fences(group: list[str], name: str) -> DataFrame:
        merged = sketches.groupBy(*group, "k", "step").agg(F.sum("n").alias("n"))
        own = Window.partitionBy(*group, "k")
        merged = merged.withColumns({"upto": F.sum("n").over(own.orderBy("step")), "total": F.sum("n").over(own)})
        middle = lambda part: (F.min(F.when(4 * F.col("upto") >= part * F.col("total"), F.col("step"))) + 0.5) / STEPS
        q = merged.groupBy(*group, "k").agg(middle(1).alias("q1"), middle(3).alias("q3"), F.first("total").alias("total"))
        wide = F.greatest(F.col("q3") - F.col("q1"), F.get(least, F.col("k"))) * reach
        low = F.when(F.get(both, F.col("k")), F.col("q1") - wide).otherwise(float("-inf"))
        line = F.struct("k", low.alias("low"), (F.col("q3") + wide).alias("high"))
        return q.groupBy(*group).agg(F.max("total").alias(f"n_{name}"), F.array_sort(F.collect_list(line)).alias(name))

    own, by_lang, by_all = fences(["lang", "source"], "own"), fences(["lang"], "by_lang"), fences([], "by_all")
    by_lang = by_lang.withColumnRenamed("lang", "_lang")
    # every (language, source) of the rows gets a line, also one whose rows all fail the base rules
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("_one", F.lit(1)).join(by_all.withColumn("_one", F.lit(1)), "_one")
    chosen = F.when(F.col("n_own") >= few, F.col("own")).when(F.col("n_by_lang") >= few, F.col("by_lang")).otherwise(F.col("by_all"))
    return written(joined.select(F.col("lang").alias("__cut_lang"), F.col("source").alias("__cut_source"), chosen.alias("__cut_fences")), "quality-cut-offs")


def verdicts(rows: DataFrame, fences: DataFrame, prefix: str = "") -> DataFrame:
    """The rows with the columns base_failed and kept, under the prefix."""
    same = F.col("lang").eqNullSafe(F.col("__cut_lang")) & F.col("source").eqNullSafe(F.col("__cut_source"))
    inside = F.lit(True)
    for i, value in enumerate(ratios(prefix).values()):
        inside = inside & (value >= F.col("__cut_fences")[i]["low"]) & (value <= F.col("__cut_fences")[i]["high"])
    failed = base_failed(prefix)
    joined = rows.join(fences, same, "left")
    return joined.withColumns({
        f"{prefix}base_failed": failed, f"{prefix}kept": ~failed & F.coalesce(inside, F.lit(False)),
    }).drop("__cut_lang", "__cut_source", "__cut_fences")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept of documents (doc_id, text, lang, source); texts are read once."""
    rows = written(measured(docs, ["doc_id", "lang", "source"]), "quality-measures")
    return verdicts(rows, cut_offs(rows))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns. Texts are read twice and never shuffled: once for the cut-offs,
    once for the verdicts, where the joined table has a row per language and source."""
    p = "__quality_"
    fences = cut_offs(measured(docs, ["lang", "source"], prefix=p), p)
    rows = measured(docs, docs.columns, prefix=p)
    return verdicts(rows, fences, p).filter(f"{p}kept").select(*docs.columns)
