"""Joins. Physical strategy is left to Spark: AQE broadcasts a side only after measuring it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a key from which on it counts as heavy, and how many such keys of a frame are joined apart.
HEAVY_ROWS, HEAVY_KEYS = 100_000, 256
#: Buckets of keys that are counted to find heavy ones where their number need not be few.
BUCKETS = 4096


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def _not_in(rows: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Anti join against distinct keys, written as a marked left join: Spark pushes an anti join
    below projections, and then its shuffle of ``rows`` no longer equals the other join's."""
    marked = keys.withColumn("_seen", F.lit(True))
    return rows.join(marked, on, "left").where(F.col("_seen").isNull()).drop("_seen")


def heavy_keys(df: DataFrame, on: list[str], rows: int = HEAVY_ROWS, most: int = HEAVY_KEYS) -> DataFrame:
    """Hashes (``_h``) of the keys that may have more than ``rows`` rows, ``most`` at most, found by a mergeable
    frequent-items sketch: each task keeps a few counters, and only those are shuffled. The sketch never counts too
    few, so a heavy key is missed only where more than ``most`` are heavier."""
    top = F.call_function("approx_top_k", F.xxhash64(*on), F.lit(most), F.lit(16 * most))
    found = df.where(~_any_null([F.col(c) for c in on])).agg(top.alias("_t"))
    return found.select(F.explode("_t").alias("_t")).where(F.col("_t.count") > rows).select(F.col("_t.item").alias("_h"))


def outer_chain(frames: list[DataFrame], on: list[str], bounded: bool = False, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Full outer join of several frames on the same columns, keys coalesced.

    Spark's full outer sort-merge join runs every hot key, and every null key, in a single task
    and AQE may not split it. So the keys that are heavy in any frame (``heavy_keys``) are joined apart, by inner
    joins, which AQE splits on whichever side is hot, plus the rows of either side whose key is not among the
    other's. All other keys are joined natively; where no key is heavy, that is all there is: the table of heavy keys, a
    few rows that are broadcast, turns out empty and AQE drops the other branch. Of three frames or more the products of
    the first are not shuffled (``_keyed_chain``). Rows with a null key match nothing
    and skip the joins. ``bounded`` says that the rows per key are known to be few; ``heavy_rows=0`` takes every key
    for heavy, without sketches, so that a filter on the result reaches all scans of the frames.
    """
    if bounded:
        return reduce(lambda a, b: a.join(b, on, "outer"), frames)
    no_key = _any_null([F.col(c) for c in on])
    keyed = [f.where(~no_key).withColumn("_h", F.xxhash64(*on)) for f in frames]
    if not heavy_rows:
        return _stack([_split_chain(keyed, on), *[f.where(no_key) for f in frames]])
    heavy = F.broadcast(reduce(DataFrame.union, [heavy_keys(f, on, heavy_rows) for f in frames]).distinct())
    light = _keyed_chain([f.join(heavy, "_h", "left_anti").drop("_h") for f in keyed], on)
    split = _split_chain([f.join(heavy, "_h", "left_semi") for f in keyed], on)
    return _stack([light, split, *[f.where(no_key) for f in frames]])


def _keyed_chain(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of frames without null keys. Nothing is known of the partitioning of a full outer join's result, so
    the product of two frames would be shuffled to meet the third. Left joins from the distinct keys of all frames keep the keys'
    partitioning: each frame is shuffled once, and products only stream through a task."""
    if len(frames) < 3:
        return reduce(lambda a, b: a.join(b, on, "outer"), frames)
    keys = reduce(DataFrame.union, [f.select(*on).distinct() for f in frames]).distinct()
    return reduce(lambda a, b: a.join(b, on, "left"), frames, keys)


def outer_left(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join on the same columns, keys coalesced, of frames of which the first has the keys with many rows: a left
    join, which AQE splits on that side or makes a broadcast, and the rows of the second whose key the first lacks.

    Both parts read the second frame alike (null-safe conditions push no filter into one of them), so its shuffle is
    shared and nothing is read beforehand to look for heavy keys. Rows with a null key match nothing.
    """
    no_key = _any_null([F.col(c) for c in on])
    names = {c: f"_k_{c}" for c in on}
    a = big.withColumn("_a", no_key.cast("int"))  # 0 with a key, 1 without one; 0 and 2 on the other side
    b = small.withColumnsRenamed(names).withColumn("_b", F.when(_any_null([F.col(c) for c in names.values()]), 2).otherwise(0))
    cond = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()], F.col("_a") == F.col("_b"))
    joined = a.join(b, cond, "left").drop("_a", "_b", *names.values())
    known = a.select(*on, "_a").distinct()
    alone = _not_in(b, known, cond).drop("_a", "_b", *on).withColumnsRenamed({k: c for c, k in names.items()})
    return _stack([joined, alone])


def _split_chain(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join by inner joins and unmatched rows; the frames have their keys' hash in ``_h``."""
    # Joining on a hash as well as the keys makes sorting compare longs, and a hash recomputed per
    # step gives it a shuffle of its own: AQE splits a join only if the next one does not rely on
    # its partitioning.
    hashed, mark = ["_h", *on], F.xxhash64(*on)
    keys = [f.select(*hashed).distinct() for f in frames]
    out = frames[0]
    for i, nxt in enumerate(frames[1:], 1):
        known = keys[0] if i == 1 else reduce(DataFrame.union, keys[:i]).distinct()
        step = _stack([out.join(nxt, hashed, "inner"), _not_in(out, keys[i], hashed), _not_in(nxt, known, hashed)])
        out = step.drop("_h").withColumn("_h", mark)
    return out.drop("_h")


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _bucket(key: str) -> Column:
    """The bucket of a row's key, -1 without one. Never null, so that joins on it push no filter on nulls into the scans of
    one branch only, which would keep branches from sharing a shuffle."""
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def heavy_buckets(df: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """The buckets (``_h``) that hold ``rows`` rows more than twice their share: each key with that many is in one, and the
    few other keys beside it. A count per bucket combines map-side and costs less than a sketch of the keys."""
    counts = df.where(F.col(key).isNotNull()).groupBy(_bucket(key).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    whole = counts.agg(F.collect_list(F.struct("_h", "_n")).alias("_b"), F.sum("_n").alias("_all"))
    return whole.select(F.explode("_b").alias("_b"), "_all").where(F.col("_b._n") > rows + 2 * F.col("_all") / BUCKETS).select(F.col("_b._h").alias("_h"))


def _dealt(df: DataFrame, key: str, spread: str, distinct: bool) -> DataFrame:
    """Rows dealt by their key, those without one by their content; copies of a row meet in a task."""
    content = F.xxhash64(*[c for c in df.columns if c != key])
    out = df.withColumn(spread, F.when(F.col(key).isNull(), content).otherwise(F.lit(0).cast("long"))).repartition(key, spread)
    return out.dropDuplicates() if distinct else out


def outer_on(
    left: DataFrame, right: DataFrame, lkey: Column, rkey: Column, distinct: bool = False, heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Full outer join on one expression per side, both sides' columns kept; ``distinct`` takes each side as a set of rows.

    As in ``outer_chain``, keys that are heavy on a side are joined apart, with the rest of their buckets, so that AQE can
    split them. All other rows are shuffled once: copies are removed and keys matched by one partitioning; rows without a key match nothing and are
    spread by their content.
    """
    a, b = left.withColumn("_lk", lkey), right.withColumn("_rk", rkey)
    buckets = [heavy_buckets(f.select(k), k, heavy_rows) for f, k in ((a, "_lk"), (b, "_rk"))]
    heavy = F.broadcast(reduce(DataFrame.union, buckets).distinct())
    of_a, of_b = (_bucket(k) == F.col("_h") for k in ("_lk", "_rk"))
    la, lb = _dealt(a.join(heavy, of_a, "left_anti"), "_lk", "_ls", distinct), _dealt(b.join(heavy, of_b, "left_anti"), "_rk", "_rs", distinct)
    light = la.join(lb, (F.col("_lk") == F.col("_rk")) & (F.col("_ls") == F.col("_rs")), "outer").drop("_ls", "_rs")
    ka, kb = a.join(heavy, of_a, "left_semi"), b.join(heavy, of_b, "left_semi")
    of_left, of_right = ka.where("_lk IS NOT NULL").select("_lk").distinct(), kb.where("_rk IS NOT NULL").select("_rk").distinct()
    if distinct:
        ka, kb = ka.dropDuplicates(), kb.dropDuplicates()
    cond = F.col("_lk").eqNullSafe(F.col("_rk"))
    return _stack([light, ka.join(kb, cond, "inner"), _not_in(ka, of_right, cond).drop("_rk"), _not_in(kb, of_left, cond).drop("_lk")]).drop("_lk", "_rk")


def _key_digest(df: DataFrame, keys: list[str]) -> Column:
    """SHA-256 of a row's trimmed keys, each with its length before it, so that no two rows of keys read the same; a null
    key is a key of its own."""
    parts = [(trimmed := F.trim(df[k]), F.concat(F.length(trimmed).cast("string"), F.lit(":"), trimmed))[1] for k in keys]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256))


def anti_trim(new: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose trimmed keys are not in ``gold``; a null key equals a null key. Keys may be whole texts, so
    what is shuffled of ``gold`` are their digests, and they are merged: Spark would broadcast millions of them where the
    files of the keys are small."""
    seen = gold.select(_key_digest(gold, keys).alias("_g")).distinct().hint("merge")
    return new.withColumn("_n", _key_digest(new, keys)).join(seen, F.col("_n") == F.col("_g"), "left_anti").drop("_n")


def join_ci(a: DataFrame, b: DataFrame, ka: str, kb: str) -> DataFrame:
    """Inner join on names compared without case."""
    return a.join(b, F.lower(a[ka]) == F.lower(b[kb]), "inner")


def join_id(a: DataFrame, b: DataFrame, ka: str, kb: str) -> DataFrame:
    return a.join(b, a[ka] == b[kb], "inner")


def join_station(a: DataFrame, b: DataFrame, key: str = "STATION") -> DataFrame:
    """Station-level join of two detail tables; its size is a product per station, so filter both
    sides first or use :func:`pair_profile`."""
    return a.join(b, a[key] == b[key], "inner")


def pair_profile(
    sides: list[tuple[DataFrame, Column, dict[str, Column]]], key: str, by: list[list[str]] | None = None
) -> DataFrame:
    """What an n:m inner join would contain per key, without producing its pairs.

    Every side is aggregated before the join: ``PAIRS`` is the product of the row counts, and the
    sum of a measure over the pairs is its own sum times the row counts of the other sides.
    ``by`` names extra grouping columns per side.
    """
    by = by or [[] for _ in sides]
    grouped = []
    for i, ((df, k, measures), extra) in enumerate(zip(sides, by)):
        aggs = [F.count(F.lit(1)).alias(f"_n{i}")] + [F.sum(c).alias(n) for n, c in measures.items()]
        grouped.append(
            df.withColumn("_k", k).where(F.col("_k").isNotNull()).groupBy("_k", *extra).agg(*aggs)
        )
    out = reduce(lambda a, b: a.join(b, "_k", "inner"), grouped)
    rows = [F.col(f"_n{i}") for i in range(len(sides))]
    cols = [F.col("_k").alias(key)] + [F.col(c) for extra in by for c in extra]
    cols.append(reduce(lambda a, b: a * b, rows).alias("PAIRS"))
    for i, (_, _, measures) in enumerate(sides):
        others = reduce(lambda a, b: a * b, [r for j, r in enumerate(rows) if j != i], F.lit(1))
        cols += [(F.col(n) * others).alias(n) for n in measures]
    return out.select(*cols)
