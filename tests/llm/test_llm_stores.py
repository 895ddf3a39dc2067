"""Token store, WARC bundles and packing: exact round trips against plain Python."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import awkward, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationcast.llm import packing, token_store, tokens, warc
from stationcast.llm.support import scratch


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


def library():
    """The plain call of the library, without any flag."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b\x1c\x85\xa0 ᠎​﻿'sétlab1²,.!<|endoftext|>́中😀", max_size=40))
def test_pieces_give_the_tokenizers_ids(text):
    enc = tokens.encoder(tokens.default_path())
    assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "a", "b1", "'s", "<|", "|>", "é", "\xa0", "."]), max_size=12).map("".join), max_size=4))
def test_added_tokens_have_the_librarys_ids(texts):
    enc, plain = tokens.encoder(tokens.default_path()), library()
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_in_the_store_and_the_packing(spark):
    texts = ["one<|endoftext|>two", " <|endoftext|> <|endoftext|>x ", "<|endoftext|>", "none at all"]
    want = [library().encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.count(50256) for i in want] == [1, 2, 1, 0]
    df = frame(spark, [(i, t, "en", "s", 0, 0, 0.0, "k") for i, t in enumerate(texts)])
    store = token_store.write_store(df, scratch(spark, "t"))
    rows = token_store.read_digests(store, token_store.lookup(store, token_store.open_keys(spark, store))).collect()
    assert sorted((r.key, r.n_tokens, r.ids_crc32) for r in rows) == [(i, len(x) + 1, crc([*x, 0])) for i, x in enumerate(want)]
    assert sum(r.length for r in packing.pack(df.select("doc_id", "text")).collect()) == sum(len(x) + 1 for x in want)


def test_perfect_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**63, 20000, dtype=np.uint64))
    built = token_store.PerfectHash.build(h)
    assert sorted(built.slots(h)) == list(range(len(h)))
    data = token_store.index_bytes(h, np.arange(len(h)), np.arange(len(h)) * 3, np.ones(len(h), int))
    found, got = token_store.index_lookup(data, h)
    assert found.all() and (got["offset"] == np.arange(len(h)) * 3).all()
    found, _ = token_store.index_lookup(data, rng.integers(0, 2**63, 20000, dtype=np.uint64) | np.uint64(1 << 63))
    assert not found.any()
    assert not token_store.index_lookup(token_store.index_bytes(*[np.zeros(0, np.uint64)] * 4), h[:5])[0].any()


def expected_store(tokenizer, rows):
    """Rows with their ids in key order; rows of one key in any order."""
    return [(k, [*ids_of(tokenizer, t), 0]) for k, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


@pytest.mark.parametrize("bucket_keys", [7, 50_000])
def test_token_store_round_trip(spark, tokenizer, bucket_keys):
    rows = awkward()
    store = token_store.write_store(frame(spark, rows), scratch(spark, "t"), bucket_keys=bucket_keys)
    places = token_store.lookup(store, token_store.open_keys(spark, store))
    got = [tuple(r) for r in token_store.read_digests(store, places).collect()]
    want = expected_store(tokenizer, rows)
    assert sorted((k is None, k or 0, len(i), crc(i)) for k, i in want) == sorted((g[0] is None, g[0] or 0, g[3], g[4]) for g in got)
    # starts are the running total in key order
    at = 0
    for key, _, start, n, _ in sorted(got, key=lambda g: g[2]):
        assert start == at
        at += n
    in_order = [g[0] for g in sorted(got, key=lambda g: g[2])]
    assert in_order == [k for k, _ in want]
    # ordinals tell rows of one key apart
    assert sorted(g[1] for g in got if g[0] is None) == [0, 1, 2] and sorted(g[1] for g in got if g[0] == 7) == [0, 1, 2]


def test_token_store_lacks_strangers_and_takes_nothing(spark):
    store = token_store.write_store(frame(spark), scratch(spark, "t"))
    strange = spark.createDataFrame([(99999, 0), (0, 5), (0, 0)], "key long, ordinal long")
    assert [r.key for r in token_store.lookup(store, strange).collect()] == [0]
    none = token_store.write_store(empty(spark), scratch(spark, "t"))
    assert token_store.read_digests(none, token_store.lookup(none, token_store.open_keys(spark, none))).count() == 0


PAGES = "page_id long, url string, html string, key string, digest string"


def pages(rng):
    rows = [(i, f"http://h{i % 5}.org/{i}", "same" if i % 3 == 0 else f"<p>{rng.random()}</p>" * rng.randrange(1, 50)) for i in range(60)]
    rows += [(100, None, None), (101, "http://x/\r\nEvil: 1", ""), (102, "u", "é \r\n\r\nWARC/1.1\r\n"), (103, "u", "long " * 400000), (5, "u", "again"), (5, "u", "again"), (None, "n", "same"), (None, "n", None)]
    return [(*r, "k", "d") for r in rows]


@pytest.mark.parametrize("least,frame_bytes", [(0, 1 << 20), (5, 2000)])
def test_warc_round_trip(spark, least, frame_bytes):
    rows = pages(random.Random(3))
    archive = warc.write_archive(spark.createDataFrame(rows, PAGES), scratch(spark, "w"), least=least, frame_bytes=frame_bytes)
    got = warc.read_archive(archive)
    top = {}
    for k, _, h, *_ in rows:
        if k is not None:
            top[h or ""] = max(top.get(h or "", k), k)
    want = []
    for k, _, h, *_ in rows:
        data = (h or "").encode()
        copy = len(data) >= least and top.get(h or "") is not None and top[h or ""] != k
        want.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if copy else "response", top[h or ""] if copy else None))
    plain = [tuple(r) for r in got.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(plain, key=str) == sorted(want, key=str)
    # the index points at each record's place in its frame
    index = sorted((tuple(r) for r in archive.index.select("key", "bundle", "frame", "offset").collect()), key=str)
    assert index == sorted((tuple(r) for r in got.select("key", "bundle", "frame", "offset").collect()), key=str)
    if frame_bytes < 1 << 20:
        assert archive.index.agg({"frame": "max"}).first()[0] > 0
    one = warc.read_records(archive, spark.createDataFrame([(102,), (4711,)], "id long"), "id").collect()
    assert [r.key for r in one] == [102] and bytes(one[0].block).endswith("é \r\n\r\nWARC/1.1\r\n".encode())


def test_archive_is_read_through_its_index(spark):
    """As many tasks as bundles, and an index that is wrong in any place is an error."""
    rows = [(i, "u", f"<p>{i}</p>" * 30, "k", "d") for i in range(200)]
    frame = spark.createDataFrame(rows, PAGES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive = warc.write_archive(frame, scratch(spark, "w"), frame_bytes=2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    bundles = archive.index.select("bundle").distinct().count()
    assert bundles > 4 and warc.read_archive(archive).rdd.getNumPartitions() == bundles and warc.read_archive(archive, readers=2).rdd.getNumPartitions() == 2
    at = F.col("key") == archive.index.filter("frame > 0 AND offset > 0").first().key
    wrong = [
        archive.index.withColumn("offset", F.when(at, F.col("offset") + 1).otherwise(F.col("offset"))),
        archive.index.withColumn("frame", F.when(at, F.col("frame") - 1).otherwise(F.col("frame"))),
        archive.index.withColumn("key", F.when(at, -5).otherwise(F.col("key")).cast("long")),
        archive.index.filter(~at),
        archive.index.filter("frame > 0"),
        archive.index.join(archive.index.groupBy("bundle").agg(F.max("frame").alias("last")), "bundle").filter("frame < last").drop("last"),
    ]
    for index in wrong:
        with pytest.raises(Exception, match="index|WARC"):
            warc.read_archive(warc.Archive(archive.folder, index)).collect()


def test_warc_of_nothing(spark):
    archive = warc.write_archive(spark.createDataFrame([], PAGES), scratch(spark, "w"))
    assert warc.read_archive(archive).count() == 0


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_plan_places_every_id_once(n):
    rng, histogram = random.Random(n), {}
    for _ in range(n):
        k = min(2047, int(rng.lognormvariate(6, 1)) + 1)
        histogram[k] = histogram.get(k, 0) + 1
    plan, used = packing.make_plan(histogram, 7), {}
    for k, v in histogram.items():
        for r in range(v):
            for s, o, size in plan.place(k, r):
                used.setdefault(s, []).append((o, size))
    assert sorted(used) == list(range(7, 7 + len(used)))
    for spans in used.values():
        end = 0
        for o, size in sorted(spans):
            assert o == end
            end += size
        assert end == 2048 or end & (end - 1) == 0
    assert sum(s for x in used.values() for _, s in x) == sum(k * v for k, v in histogram.items())


def test_least_squares_solves_what_can_be_solved():
    combos = packing.combinations([100, 948, 1024, 1948], 2048)
    assert ((100, 1), (1948, 1)) in combos and ((1024, 2),) in combos
    exact = {100: 30, 1948: 30, 1024: 10}
    x = packing.least_squares([c for c in combos if 948 not in dict(c)], exact)
    assert sum(x) == pytest.approx(35, abs=0.1)


def test_every_triple_that_fills_a_window_is_packed():
    plan = packing.make_plan({101: 5, 200: 5, 250: 5, 1747: 5}, 0)
    for length in (101, 200, 1747):
        assert [[n for *_, n in plan.place(length, r)] for r in range(5)] == [[length]] * 5
    assert len({plan.place(n, r)[0][0] for n in (101, 200, 1747) for r in range(5)}) == 5
    left = {k: 1 + k * 7 % 3 for k in range(1, 2048)}
    before, packed = dict(left), packing.triple_fill(left, 2048)
    used = dict.fromkeys(left, 0)
    for combo, times in packed:
        assert sum(k * m for k, m in combo) == 2048 and times > 0
        for k, m in combo:
            used[k] += m * times
    assert {k: left[k] + used[k] for k in left} == before and min(left.values()) >= 0
    open_ = {k for k, v in left.items() if v}
    assert not any(2048 - a - b in open_ for a in open_ for b in open_ if a < b < 2048 - a - b)


def test_lookup_with_a_key_a_bucket(spark):
    """Buckets without keys, the highest among them, lose nothing."""
    for n in (1, 2, 3, 5, 9, 17, 50):
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(n)], "doc_id long, text string")
        store = token_store.write_store(docs, scratch(spark, "t"), bucket_keys=1)
        keys = token_store.open_keys(spark, store)
        places = token_store.lookup(store, keys)
        assert sorted(r.key for r in token_store.read_digests(store, places, complete=True).collect()) == list(range(n))
        absent = spark.createDataFrame([(n + 7, 0)], "key long, ordinal long")
        assert token_store.lookup(store, keys.unionByName(absent)).count() == n
    with pytest.raises(Exception, match="the index finds 49 of the 50"):
        token_store.read_digests(store, places.filter("key <> 3").coalesce(1), complete=True).collect()


def test_packing_round_trip(spark, tokenizer):
    rows = awkward()
    pieces = packing.pack(frame(spark, rows), window=256, with_ids=True).persist()
    got = [r.asDict() for r in pieces.collect()]
    want = sorted((str(k), tuple([*ids_of(tokenizer, t), 1])) for k, t, *_ in rows)
    by_sequence = {}
    for g in got:
        ids = np.frombuffer(g["ids"], "<u4").tolist()
        assert crc(ids) == g["ids_crc32"] and len(ids) == g["length"] <= 256
        by_sequence.setdefault(g["sequence_id"], []).append((g["offset"], g["length"], ids))
    for spans in by_sequence.values():
        end = 0
        for o, n, _ in sorted(spans):
            assert o == end
            end += n
        assert end == 256 or end & (end - 1) == 0
    # rebuild: rows with a unique id
    unique = {k for k in (r[0] for r in rows) if [r[0] for r in rows].count(k) == 1}
    for k in unique:
        mine = sorted((g["start"], np.frombuffer(g["ids"], "<u4").tolist(), g["doc_tokens"]) for g in got if g["doc_id"] == k)
        ids = [i for _, part, _ in mine for i in part]
        assert (str(k), tuple(ids)) in want and all(n == len(ids) for *_, n in mine)
    assert sum(g["length"] for g in got) == sum(len(i) for _, i in want)
    joined = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(pieces).collect()}
    assert joined == {s: [i for _, _, p in sorted(x) for i in p] for s, x in by_sequence.items()}
    assert packing.pack(empty(spark)).count() == 0
