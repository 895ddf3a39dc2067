"""The registered queries of the subpackage, and the pipeline, over the smallest tables."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from tools.compare import compare, connect

from stationcast.llm import queries, toxicity
from stationcast.llm.support import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, con, name):
    note = compare(spark, con, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert note.startswith("ok") and "types" not in note, note


def test_ids_of_all_documents(spark, con):
    """op1 and op8 against the tokenizer on whole texts."""
    from tokenizers import Tokenizer

    from stationcast.llm.tokens import default_path

    t = Tokenizer.from_file(default_path())
    docs = con.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    ids = {k: t.encode(x, add_special_tokens=False).ids for k, x in docs}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    start, want = 0, []
    for k, _ in docs:
        want.append((k, start, len(ids[k]) + 1, crc([*ids[k], 0])))
        start += len(ids[k]) + 1
    assert sorted(tuple(r) for r in queries.QUERIES["op1_token_store"](spark, SF).collect()) == want
    pieces, done = queries.QUERIES["op8_packing"](spark, SF).collect(), {}
    for r in pieces:
        whole = [*ids[r.doc_id], 1]
        assert r.doc_tokens == len(whole) and crc(whole[r.start : r.start + r.length]) == r.ids_crc32
        done[r.doc_id] = done.get(r.doc_id, 0) + r.length
    assert done == {k: len(v) + 1 for k, v in ids.items()}


def test_toxicity_of_all_documents(spark):
    got = queries.QUERIES["op6_toxic_passages"](spark, "/root/testdata/sf0.01").select("doc_id", "held_out", "score", "predicted").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % toxicity.FOLDS == 0) and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) / len(held) > 0.9 and not [1 for p, y in held if p and not y]


def test_toxicity_finds_held_out_rows(spark):
    """Recall on rows that were not learnt from, where there are enough to learn from."""
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op6_toxic_passages"](spark, sf).select("doc_id", "held_out", "predicted").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    found, toxic = sum(p for p, y in held if y), sum(y for _, y in held)
    assert toxic > 50 and found / toxic >= 0.9 and sum(p for p, y in held if not y) <= len(held) // 200


def test_main_text_of_all_pages(spark):
    import html
    import re

    got = {r.page_id: r for r in queries.QUERIES["op9_main_text"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
        if name in ("quality_rules", "toxicity", "near_duplicates"):
            assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        counts.append(out.count())
        docs = out
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    whole = docs.groupBy("sequence_id").sum("length").collect()
    assert all(n <= 2048 for _, n in whole) and [s for s, _ in sorted(whole)] == list(range(len(whole)))
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
