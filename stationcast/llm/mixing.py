"""Mixing sources to target weights, with DataFrame operations only.

1. Sources, ordered by code point with null last, have weights that repeat; they share `share` times all words. A
   target stops at `most` times its source's words and the excess is shared again by weight.
2. The mix is dealt in blocks of `block` words. Sainte-Laguë's highest quotients size / (2 k + 1) give each source
   its integer number of blocks, and then, within a source, each shard its quota. A shard is a set of whole
   documents that a hash of the seed deals out, of about `shard_words` words.
3. A shard's documents lie one after another in seeded order and are cut into blocks. A quota of q blocks of n
   takes the shard q div n times whole, and once more q mod n neighbouring blocks (round the end) from a seeded
   start. What a document gives is where those blocks overlap it: at most `most` times its words, and only the
   documents at the two ends of the run of blocks give a part.

Everything after the word counts works on (document, source, words) rows; no text is shuffled.

Defined results: a null text has no words; a document without words gives none; rows with the same document id are
separate documents; an empty table gives no rows. `source` may be null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.support import WORD, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 16
SHARD_WORDS = 1 << 22
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Words of a text, by the blanks and line controls between them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, weight, target from one row per source (source, source_size)."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = written(sources.withColumn("weight", weight.cast("long")), "mix-sources")
    cap = F.col("source_size") * float(most)
    full = F.lit(False)
    closed = -1
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * float(share)
    while True:  # each round closes at least one more source, or is the last
        left, weight_left, count = rows.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count_if(full),
        ).first()
        if count == closed:
            break
        closed = count
        full = full | (cap * F.lit(float(weight_left)) < F.col("weight") * F.lit(left)) if weight_left else full
    even = F.col("weight") * F.lit(left) / F.lit(float(weight_left or 1))
    return rows.withColumn("target", F.when(full, cap).otherwise(even))


def apportioned(items: DataFrame, group: list[str], order: list[Column], weight: str, seats: str, out: str) -> DataFrame:
    """Sainte-Laguë within each group: `seats` blocks go one by one to the item with the highest weight / (2 k + 1),
    k being what it has; ties to the first in `order`. With n items and share q of the seats, an item gets between
    q (1 - n / 2 seats) - 1/2 and q (1 + n / 2 seats) + 3/2, so only quotients in that range are compared: about
    three for each item."""
    whole = Window.partitionBy(*group)
    items = items.withColumns({"_w": F.sum(weight).over(whole), "_n": F.count(F.lit(1)).over(whole)})
    items = items.withColumn("_place", F.row_number().over(whole.orderBy(*order)))
    q = F.when(F.col("_w") > 0, F.col(weight) * F.col(seats) / F.col("_w")).otherwise(F.lit(0.0))
    spread = F.when(F.col("_w") > 0, F.col(weight) * F.col("_n") / (F.col("_w") * 2)).otherwise(F.lit(0.0))
    items = items.withColumn("_low", F.greatest(F.lit(0), F.ceil(q - spread - 0.5) - 1).cast("long"))
    items = items.withColumn("_high", F.floor(q + spread + 1.5).cast("long"))
    items = items.withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    quotients = items.filter(F.col(weight) > 0).select(
        *group, "_place", "_open", weight, F.explode(F.sequence("_low", "_high")).alias("_k")
    ).withColumn("_q", F.col(weight) / (F.col("_k") * 2 + 1))
    ranked = quotients.withColumn("_r", F.row_number().over(whole.orderBy(F.col("_q").desc(), "_place", "_k")))
    won = ranked.filter("_r <= _open").groupBy(*group, "_place").agg(F.count(F.lit(1)).alias("_won"))
    same = [items[g].eqNullSafe(won[g]) for g in group] + [items["_place"] == won["_place"]]
    joined = items.join(won, same, "left").select(items["*"], F.coalesce("_won", F.lit(0)).alias("_won"))
    return joined.withColumn(out, F.col("_low") + F.col("_won")).drop("_w", "_n", "_place", "_low", "_high", "_open", "_won")


def _number(value: Column) -> Column:
    """The first 32 bits of an md5 as a number."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def mix_sizes(
    sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK,
    shard_words: int = SHARD_WORDS, seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size rows with source_size, target, taken, and where the partial pass lies in the document:
    whole (passes over all of it), part_from and part_to (words, two runs a and b for a run round the end)."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    targets = source_targets(per_source, weights, share, most)
    blocks = targets.withColumn("_all", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long"))
    blocks = apportioned(blocks.withColumn("_one", F.lit(0)), ["_one"], [F.col("source").asc_nulls_last()], "target", "_all", "source_blocks")
    # an empty document counts as one word here, so that shards are bounded in rows too
    shards = F.ceil((F.col("source_size") + F.col("documents")) / F.lit(shard_words)).cast("long")
    blocks = written(blocks.select("source", "source_size", "target", "source_blocks", shards.alias("shards")), "mix-targets")

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    order = F.md5(F.concat(F.lit(f"{seed}|"), key))
    docs = sizes.join(blocks.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    docs = docs.withColumns({"_h": order, "shard": _number(F.concat(F.lit(f"{seed}|shard|"), key)) % F.col("shards")})
    shard = Window.partitionBy("source", "shard")
    docs = docs.withColumn("_end", F.sum("size").over(shard.orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)))

    totals = docs.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks"))
    quotas = apportioned(totals, ["source"], [F.col("shard")], "shard_size", "source_blocks", "quota")
    n = F.ceil(F.col("shard_size") / block).cast("long")
    quotas = quotas.withColumn("n", n).withColumn("quota", F.least(F.col("quota"), F.col("n") * most))
    name = F.concat(F.lit(f"{seed}|start|"), F.coalesce("source", F.lit("")), F.lit("|"), F.col("shard").cast("string"))
    quotas = quotas.filter("n > 0").select(
        F.col("source").alias("_s"), F.col("shard").alias("_sh"), F.col("shard_size"),
        F.floor(F.col("quota") / F.col("n")).cast("long").alias("passes"), (F.col("quota") % F.col("n")).alias("run"),
        (_number(name) % F.col("n")).alias("begin"), F.col("n"),
    )
    mixed = docs.join(quotas, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_sh")), "left")
    start = F.col("_end") - F.col("size")
    # the run covers blocks [begin, begin + run) and, round the end, [0, begin + run - n)
    lo_a, hi_a = F.col("begin") * block, F.least(F.col("begin") + F.col("run"), F.col("n")) * block
    hi_b = F.greatest(F.col("begin") + F.col("run") - F.col("n"), F.lit(0)) * block
    within = lambda x: F.least(F.greatest(x - start, F.lit(0)), F.col("size"))
    mixed = mixed.withColumns({
        "whole": F.coalesce("passes", F.lit(0)), "b_to": F.coalesce(within(hi_b), F.lit(0)),
        "a_from": F.coalesce(within(lo_a), F.lit(0)), "a_to": F.coalesce(within(hi_a), F.lit(0)),
    })
    taken = F.col("whole") * F.col("size") + F.col("a_to") - F.col("a_from") + F.col("b_to")
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "whole", "a_from", "a_to", "b_to",
        *[c for c in sizes.columns if c not in ("doc_id", "source", "size")],
    )


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mix of the documents as in `mix_sizes`; the word counts are written once."""
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    return mix_sizes(written(sizes, "mix-sizes"), **settings)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix themselves, with the columns of `docs` (doc_id, text, source and, if there, n_chars): a
    row for each whole pass and one for each partial pass that holds some of its words. A partial pass over all of a
    document is its text; over some words it is those words, joined by blanks. Rows alike in doc_id, source and text
    are told apart by a running number."""
    # the documents' columns go by number, whatever their names
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    doc_id, text, source = (F.col(at[c]) for c in ("doc_id", "text", "source"))
    rows = docs.toDF(*at.values()).withColumn("_th", F.xxhash64(text))
    alike = Window.partitionBy("doc_id", "source", "_th")
    sizes = rows.select(doc_id.alias("doc_id"), source.alias("source"), word_count(text).alias("size"), "_th")
    sizes = sizes.withColumn("_nth", F.row_number().over(alike.orderBy("size")))
    takes = mix_sizes(written(sizes, "mix-sizes"), **settings).filter("taken > 0")
    part = lambda kind, lo, hi: F.when(hi > lo, F.struct(F.lit(kind).alias("kind"), lo.alias("lo"), hi.alias("hi")))
    zero, size = F.lit(0).cast("long"), F.col("size")
    whole = F.struct(F.lit("whole").alias("kind"), zero.alias("lo"), size.alias("hi"))
    passes = F.concat(
        F.array_repeat(whole, F.col("whole").cast("int")),
        F.array_compact(F.array(part("a", F.col("a_from"), F.col("a_to")), part("b", zero, F.col("b_to")))),
    )
    takes = takes.select(
        *[F.col(c).alias(f"_k_{c}") for c in ("doc_id", "source", "_th", "_nth")], "size", passes.alias("_passes")
    )
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(doc_id, source, "_th").orderBy(F.lit(0))))
    same = [c.eqNullSafe(F.col(f"_k_{k}")) for k, c in (("doc_id", doc_id), ("source", source), ("_th", F.col("_th")), ("_nth", F.col("_nth")))]
    out = rows.join(takes, same).select(*at.values(), "size", F.explode("_passes").alias("_p"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("_p.lo") + 1).cast("int"), (F.col("_p.hi") - F.col("_p.lo")).cast("int")), " ")
    entire = (F.col("_p.lo") == 0) & (F.col("_p.hi") == F.col("size"))
    out = out.withColumns({at["text"]: F.when(entire, text).otherwise(cut), "_entire": entire})
    if "n_chars" in at:
        n_chars = F.col(at["n_chars"])
        out = out.withColumn(at["n_chars"], F.when(F.col("_entire"), n_chars).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(k).alias(c) for c, k in at.items()])
