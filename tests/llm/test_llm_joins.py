"""Similarity join, bit-sliced search and source mix against brute force."""

import math
import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from helpers import awkward, empty, frame, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationcast.llm import bitsliced, jaccard, mixing
from stationcast.llm.components import components


# ---------------------------------------------------------------- components and similarity

@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {
        "chain": [(i, i + 1) for i in range(40)], "star": [(i, 1000) for i in range(300)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)], "none": [],
    }[shape]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    lonely = {u for u, v in edges if u == v} - {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: x for n, x in label.items() if n not in lonely}


def brute_sets(rows, k):
    out = []
    for _, t, *_ in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        out.append(frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def brute_join(rows, k, percent):
    """(doc_id, n, component, links) per row."""
    sets = brute_sets(rows, k)
    near = {i: set() for i in range(len(rows))}
    for a, b in combinations(range(len(rows)), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            near[a].add(b)
            near[b].add(a)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((r[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else r[0], len(near[i])))
    return sorted(out, key=str)


def near_copies(seed, groups=6, copies=25):
    """Groups whose members differ by a few words each, with similarities on both sides of the threshold."""
    rng, rows, i = random.Random(seed), [], 0
    shared = words(rng, 60, 90000)
    for g in range(groups):
        base = words(rng, rng.randrange(15, 120), 90000).split()
        for _ in range(copies):
            part = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
                p = rng.randrange(len(part))
                part[p : p + rng.choice([0, 1])] = [f"x{rng.randrange(99999)}"]
            rows.append((i, " ".join(part) + (" " + shared if g % 2 else "")))
            i += 1
    rng.shuffle(rows)
    return [(n, t, "en", "s", 0, 0, 0.0, "k") for n, t in rows]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 50)])
def test_similarity_join_matches_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(jaccard, "PAIRED", 6)
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 8)
    for rows in (awkward(), near_copies(k), near_copies(9, groups=2, copies=60)):
        got = jaccard.similarity_join(frame(spark, rows), shingle_words=k, percent=percent)
        assert sorted((tuple(r) for r in got.drop("component").collect()), key=str) == brute_join(rows, k, percent)
    assert jaccard.similarity_join(empty(spark)).count() == 0


def test_sets_of_a_large_family_are_stored_once(spark, monkeypatch):
    """One family of many blocks: each class lies in one block's file, whatever the number of blocks that its own meets."""
    kept = {}

    def written(df, name):
        kept[name] = spark.createDataFrame(df.collect(), df.schema)
        return kept[name]

    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 8)
    monkeypatch.setattr(jaccard, "written", written)
    rows = near_copies(3, groups=1, copies=90)
    sets = [x for x in dict.fromkeys(brute_sets(rows, 1))]
    classes = [(i, 7, 1, len(x), bytearray(np.array(sorted(hash(w) & (2**63 - 1) for w in x), np.uint64).tobytes())) for i, x in enumerate(sets)]
    members = jaccard.blocked(spark.createDataFrame(classes, "cid long, family long, copies long, n long, set binary"), 80)
    meets = members.select(F.max(F.size("others"))).first()[0]
    got = jaccard.verified(members, 80).groupBy("cid").agg(F.sum("links").alias("links")).collect()
    want = [sum(100 * len(x & y) >= 80 * len(x | y) for y in sets) - 1 for x in sets]
    assert {r.cid: r.links for r in got} == {i: n for i, n in enumerate(want) if n}
    files = kept["jaccard-block-files"]
    assert meets > 3 and files.count() == files.select("block").distinct().count() == members.select("block").distinct().count()


def test_sketch_follows_the_text(spark, monkeypatch):
    """As many shingles to a counter, whatever the text; the join is the same for either size."""
    rows = near_copies(4)
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 12)
    small = len(jaccard.frequencies(frame(spark, rows), 3))
    monkeypatch.setattr(jaccard, "COUNTER_SHINGLES", 1 / 4)
    assert jaccard.sketch_bits(empty(spark)) == 12
    assert small == 1 << 12 < len(jaccard.frequencies(frame(spark, rows), 3)) <= 1 << jaccard.MOST_SKETCH_BITS
    got = jaccard.similarity_join(frame(spark, rows), shingle_words=3, percent=90)
    assert sorted((tuple(r) for r in got.drop("component").collect()), key=str) == brute_join(rows, 3, 90)


def test_blocks_of_far_sizes_do_not_meet(spark, monkeypatch):
    """A family tied by one common line: texts of ten to two thousand shingles."""
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 40)
    rng = random.Random(6)
    sizes = [rng.randrange(10, 2000) for _ in range(1500)] + [100, 111, 112, 90, 80, 125]
    rows = [(i, 7, n) for i, n in enumerate(sizes)] + [(9001, 8, 5), (9002, 8, 5000), (9003, 9, 5)]
    for percent in (90, 80, 50, 100):
        got = jaccard.blocked(spark.createDataFrame(rows, "cid long, family long, n long"), percent).collect()
        family = {r.cid: r for r in got if r.family == 7}
        assert len(family) == len(sizes) and {r.cid for r in got if r.family == 8} == {9001, 9002} and all(r.family != 9 for r in got)
        assert len({r.block for r in got if r.family == 8}) == 1
        held = {}
        for r in family.values():
            held.setdefault(r.block, []).append(r.n)
        pairs = {(min(r.block, o), max(r.block, o)) for r in family.values() for o in r.others if o in held}
        verified = sum(len(held[a]) * len(held[b]) if a != b else len(held[a]) * (len(held[a]) - 1) // 2 for a, b in pairs)
        every = list(family.values())
        for a, b in zip(every * 3, [every[rng.randrange(len(every))] for _ in range(3 * len(every))]):
            if 100 * min(a.n, b.n) >= percent * max(a.n, b.n):
                assert b.block in a.others and a.block in b.others
        assert verified < {100: 0.01, 90: 0.25, 80: 0.45, 50: 0.95}[percent] * len(sizes) ** 2 / 2


def test_linked_counts_every_pair():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2**60, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) < p], rng.integers(0, 2**60, 9, dtype=np.uint64)])) for p in rng.uniform(0.8, 1, 40)]
    want = [[a is not b and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (jaccard.linked(sets, None, 80) == want).all()
    assert (jaccard.linked(sets[:7], sets[7:], 80) == np.array(want)[:7, 7:]).all()


def test_one_of_each_keeps_the_smallest(spark):
    rows = near_copies(3) + [(None, "a b c d e f g", "en", "s", 0, 0, 0.0, "k")] * 3 + [(900, " ", "en", "s", 0, 0, 0.0, "k"), (901, None, "en", "s", 0, 0, 0.0, "k")]
    got = jaccard.one_of_each(frame(spark, rows), shingle_words=5, percent=80)
    assert got.columns == frame(spark, rows).columns
    want = {c for i, n, c, _ in brute_join(rows, 5, 80) if n and c is not None}
    kept = [r.doc_id for r in got.collect()]
    assert sorted(x for x in kept if x is not None) == sorted(want | {900, 901}) and kept.count(None) == 1


# ---------------------------------------------------------------- top-k

def brute_top(rows, k=5, every=50):
    found = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            found.append((i, tuple(math.floor(256 * Fraction(x)) for x in [*v, *[0.0] * (8 - len(v))])))
    out = []
    for q, v in set((i, v) for i, v in found if i is not None and i % every == 0):
        rest = list(found)
        rest.remove((q, v))
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in rest))[:k]
        out += [(q, r + 1, None if none else i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, none, i) in enumerate(scored)]
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, score long, rank int, label int"


@pytest.mark.parametrize("block_rows,query_rows", [(16, 3), (1 << 16, 256)])
def test_top_k_matches_brute_force(spark, block_rows, query_rows):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(0, 0.3, 8))]) for i in range(120)]
    rows += [(i, [0.5] * 8) for i in range(200, 260)] + [(300, [0.5] * 8)] * 4 + [(None, [0.5] * 8), (None, [-1.0] * 8)]
    rows += [(400, None), (450, [float("nan")] * 8), (500, [1.0, None]), (550, [1.0, 2.0]), (600, []), (650, [float("inf")]), (700, [1e30] * 8), (50, [0.25] * 8)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    got = bitsliced.top_k(df, block_rows=block_rows, query_rows=query_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_top(rows)


@pytest.mark.parametrize("spread", [1, 1e6, 1e15, 1e300])
def test_top_k_of_large_components(spark, spread):
    """Vectors on both sides of what the index holds, as queries and as candidates, up to the ends of a double."""
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * rng.choice([1, 1000, spread]) for _ in range(rng.randrange(1, 9))]) for i in range(150)]
    rows += [(200, [300000.0, 1.0]), (250, [1.0, 2.0]), (250, [1.0, 2.0]), (300, [1e30] * 8), (300, [1e30] * 8), (350, [-1e30, 0.5]), (351, [1.7e308, -1.7e308])]
    rows += [(400, [262143.99]), (401, [262144.0]), (450, [-262144.0]), (None, [1e9, 1e9]), (None, [2.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS.replace("float", "double"))
    got = bitsliced.top_k(df.repartition(4), block_rows=32, query_rows=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_top(rows)


def test_the_index_is_shuffled_once(spark):
    """Tasks get numbers of blocks and of queries: behind the index there is no shuffle of it."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0], 1, 2, 3) for i in range(300)], VECTORS)
    plan = bitsliced.top_k(df, block_rows=20, query_rows=2)._jdf.queryExecution().executedPlan().toString()
    assert "Range (" in plan and "bitmaps" not in plan and "Join" not in plan


def test_top_k_of_nothing(spark):
    assert bitsliced.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    assert bitsliced.top_k(spark.createDataFrame([(1, [1.0], 0, 0, 0)], VECTORS)).count() == 0
    assert bitsliced.top_k(spark.createDataFrame([(50, [1.0], 0, 0, 0)], VECTORS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(1, 5), st.integers(0, 10**6))
def test_slices_add_up_to_scores(rows, dims, seed):
    rng = np.random.default_rng(seed)
    values, query = rng.integers(-200, 200, (rows, dims)), rng.integers(-200, 200, dims)
    slices = bitsliced.slices_of(values, 9)
    sums, add = bitsliced.score_slices(slices, query)
    total = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:rows].astype(np.int64) << i for i, s in enumerate(sums)) + add
    assert (total == values @ query).all()


# ---------------------------------------------------------------- mix

def test_targets_fill_up_and_share_again(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 50), (None, 3), ("é", 0)], "source string, source_size long")
    got = {r.source: r for r in mixing.source_targets(sources).collect()}
    assert [got[s].weight for s in ("a", "b", "c", "é", None)] == [3, 1, 2, 3, 1]
    total = 1.5 * 1063
    assert got["a"].target == 20 and got["c"].target == 100 and got[None].target == 6 and got["é"].target == 0
    assert got["b"].target == pytest.approx(total - 126)


def webster(weights, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        i = max(range(len(weights)), key=lambda j: (weights[j] / (2 * won[j] + 1), -j))
        won[i] += 1
    return won


@pytest.mark.parametrize("weights,seats", [([53, 24, 23], 7), ([1, 1, 1, 1], 2), ([1000, 1, 1, 1, 1, 1, 1], 9), ([0, 5, 0, 7], 13), ([3] * 30, 100), ([7, 2, 9, 4, 4, 1], 0)])
def test_apportionment_is_sainte_lague(spark, weights, seats):
    items = spark.createDataFrame([("g", i, w, seats) for i, w in enumerate(weights)], "g string, i int, w long, seats long")
    got = mixing.apportioned(items, ["g"], [items["i"]], "w", "seats", "won").orderBy("i").collect()
    assert [r.won for r in got] == webster(weights, seats)


def test_mix_bounds_targets_and_reruns(spark):
    rows = awkward()
    docs = frame(spark, rows)
    first = mixing.mix(docs, block=4, shard_words=2000)
    again = mixing.mix(docs.repartition(5), block=4, shard_words=2000)
    plain = lambda df: sorted((tuple(r) for r in df.select("doc_id", "source", "size", "source_size", "target", "taken").collect()), key=str)
    assert plain(first) == plain(again)
    got = first.collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.whole * r["size"] + r.a_to - r.a_from + r.b_to
    sums = {}
    for r in got:
        a = sums.setdefault(r.source, [0, r.target, r.source_size])
        a[0] += r.taken
    shards = 20
    for taken, target, size in sums.values():
        assert abs(taken - target) <= 4 * (shards + 1) and taken <= 2 * size
    assert sum(t for _, t, _ in sums.values()) == pytest.approx(1.5 * sum(s for *_, s in sums.values()))
    assert mixing.mix(empty(spark)).count() == 0


def test_mixed_documents_hold_the_words_taken(spark):
    rows = awkward()
    docs = frame(spark, rows)
    got = mixing.mixed_documents(docs, block=4, shard_words=2000)
    assert got.columns == docs.columns and got.schema == docs.schema
    count = lambda t: len((t or "").encode().split())
    taken = {}
    for r in got.collect():
        assert count(r.text) > 0 and r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + count(r.text)
    want = {}
    for r in mixing.mix(docs, block=4, shard_words=2000).filter("taken > 0").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    unique = [k for k in want if [x[0] for x in rows].count(k) == 1]
    assert {k: taken.get(k) for k in unique} == {k: want[k] for k in unique}
    assert sum(taken.values()) == sum(want.values())
    assert mixing.mixed_documents(empty(spark)).count() == 0
    # columns named as helper columns are
    odd = docs.withColumnsRenamed({"key": "size", "n_words": "_p", "score": "_th"}).withColumn("_k_doc_id", F.lit(1)).withColumn("_entire", F.lit("x"))
    again = mixing.mixed_documents(odd, block=4, shard_words=2000)
    assert again.columns == odd.columns and again.count() == got.count() and {r["size"] for r in again.collect()} == {"k"}
