"""Each stage of the pipeline on what the stage before has kept, against SQL or plain Python."""

import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from test_llm_joins import brute_join

from stationcast.llm import queries, toxicity
from stationcast.llm.support import written
from stationcast.llm.tokens import default_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def view(df):
    """The frame as DuckDB's table of documents."""
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    return con


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_quality_keeps_what_the_sql_keeps(stages):
    want = view(stages[0]).execute(f"SELECT doc_id FROM ({queries.OP2_SQL}) WHERE kept").fetchall()
    assert ids(stages[1]) == sorted(k for k, in want) and len(want) < stages[0].count()


def test_toxicity_drops_what_the_model_scores(spark, stages):
    """The stage's own model, applied text by text: passages by trying every start and end."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model, kept = toxicity.learn(stages[1], labels), []
    for r in stages[1].collect():
        n, found = model.passages(r.text, {})
        weights = [model.weight(w) or -model.gap for w in toxicity.words_of(r.text)]
        sums = np.concatenate([[0.0], np.cumsum(weights)])
        best = max((sums[b] - sums[a] for a in range(len(weights)) for b in range(a + 1, len(weights) + 1)), default=0.0) if len(weights) < 400 else None
        if best is not None:  # the best passage is among those found, if any is significant
            top = max((s for _, _, s, _ in found), default=0.0)
            assert not found or abs(top - best) < 1e-6
        if model.score(model.evidence(n, model.tempered(r.text, found, {}))) < 0.5:
            kept.append(r.doc_id)
    assert ids(stages[2]) == sorted(kept)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    groups = {}
    for doc_id, n, component, _ in brute_join(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.PERCENT):
        groups.setdefault(component if n else ("alone", doc_id), []).append(doc_id)
    assert ids(stages[3]) == sorted(min(g) for g in groups.values()) and len(groups) < len(rows)


def test_the_mix_takes_what_the_sql_takes(stages):
    want = dict(view(stages[3]).execute(f"SELECT doc_id, taken FROM ({queries.OP3_SQL}) WHERE taken > 0").fetchall())
    got = {}
    for r in stages[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    texts = {r.doc_id: " ".join(r.text.split()) for r in stages[3].collect()}
    assert got == want and all(" ".join(r.text.split()) in texts[r.doc_id] for r in stages[4].collect())


def test_packed_pieces_are_the_documents(stages):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(default_path())
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    whole = [tuple([*model.encode(r.text, add_special_tokens=False).ids, 1]) for r in stages[4].collect()]
    by_doc = {}
    for r, t in zip(stages[4].collect(), whole):
        by_doc.setdefault(r.doc_id, []).append(t)
    pieces = stages[5].collect()
    assert sum(p.length for p in pieces) == sum(map(len, whole))
    for p in pieces:
        assert any(len(t) == p.doc_tokens and crc(t[p.start : p.start + p.length]) == p.ids_crc32 for t in by_doc[p.doc_id])
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    padded = 0
    for spans in sequences.values():
        end = 0
        for at, n in sorted(spans):
            assert at == end
            end += n
        assert end <= 2048
        padded += 2048 - end if end & (end - 1) else 0
    assert padded == 0
