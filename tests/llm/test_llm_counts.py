"""Token counts spliced from segments, against the library's call on whole texts."""

import random

import pytest
from helpers import awkward, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from stationcast.llm import queries
from stationcast.llm.token_counts import count_tokens, counter, counts_at, default_path, splice

PIECES = [" ", "  ", "the ", "ing", "é", "\U0001f600", "日本", "\t", "\n", "a", "aaaa", "=", "====", "_", "0", "the", ".", "▁", "<s>", "<0x41>", "\x00", "�"]


@pytest.fixture(scope="module")
def model():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=default_path())


def check(spark, model, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in count_tokens(df, limit=50, **how).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        n = len(model.encode(t or ""))
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (n, len((t or "").encode()), n > 50), (k, t)
    return got


@pytest.mark.parametrize("segment,overlap", [(8, 3), (16, 16), (64, 8)])
def test_spliced_counts_are_those_of_whole_texts(spark, model, segment, overlap):
    rng = random.Random(segment)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(200))) for _ in range(150)]
    got = check(spark, model, [*texts, None, ""], segment=segment, overlap=overlap)
    assert sum(r.segments for r in got.values()) > 2 * len(got)


def test_texts_that_never_align_become_one_segment(spark, model):
    """Tokens of sixteen equal signs, cut at seventeen: no overlap holds a shared token, however wide."""
    texts = ["=" * 1700, "ab " * 500, "a" * 999, " " * 999, "日" * 400, "\U0001f600" * 300]
    got = check(spark, model, texts, segment=17, overlap=4)
    assert got[0].segments < 10 and got[1].segments > 50


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), min_size=1, max_size=60).map("".join), st.data())
def test_a_shared_token_proves_the_splice(text, data):
    enc = counter(default_path())
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(text)), st.integers(0, len(text)))))
    left, right = counts_at(enc.ends(text[:b]), a, b), counts_at(enc.ends(text[a:]) + a, a, b)
    found = splice(*left, *right, a)
    if found:
        assert found[0] + len(enc.ends(text[a:])) - found[1] == len(enc.ends(text))


def test_awkward_rows(spark, model):
    rows = awkward()
    got = count_tokens(frame(spark, rows)).collect()
    want = sorted((str(k), len((t or "").encode()), len(model.encode(t or ""))) for k, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert max(r.segments for r in got) > 3  # the long text went through segments
    assert count_tokens(empty(spark)).count() == 0


def test_registered_query(spark, model):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op11_token_counts"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        n = len(model.encode(r.text or ""))
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 4096)
