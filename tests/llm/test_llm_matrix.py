"""The document-term matrix and the filter audit against plain Python."""

import itertools
import random
import re
from collections import Counter

import pytest
from helpers import awkward, empty, frame

from stationcast.llm import term_matrix as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("shard_words,piece", [(1 << 22, 1 << 20), (50, 40)])
def test_matrix_holds_every_word(spark, monkeypatch, shard_words, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    rows = [*awkward(), (300, "\x1cno\x85split\xa0here  A a A\x0bb\x0c", "en", "s1", 0, 0, 0.0, "k")]
    docs = frame(spark, rows).withColumnRenamed("key", "terms").repartition(3)
    matrix = M.build(docs, shard_words=shard_words)
    words = {r.term: r for r in matrix.words.join(M.term_totals(matrix), "term").collect()}
    assert matrix.words.count() == len(words)
    want, used = Counter(), Counter()
    for _, t, *_ in rows:
        own = Counter(WORD.findall(t or ""))
        want += own
        used += Counter(own.keys())
    assert sorted(words) == list(range(len(want)))  # dense numbers, one per word
    assert {r.word: (r.documents, r.uses) for r in words.values()} == {w: (used[w], want[w]) for w in want}
    got = [(r.doc_id, r.source, r.terms_, {words[t].word: c for t, c in zip(r.terms, r.counts)}, r.terms == sorted(set(r.terms))) for r in matrix.rows.collect()]
    key = lambda r: (str(r[0]), str(r[1]), sorted(r[3].items()))
    assert sorted(got, key=key) == sorted(((k, s, "k", dict(Counter(WORD.findall(t or ""))), True) for k, t, _, s, *_ in rows), key=key)
    totals = M.row_totals(matrix).select("n_words", "n_distinct").collect()
    assert sorted(map(tuple, totals)) == sorted((len(w), len(set(w))) for w in (WORD.findall(t or "") for _, t, *_ in rows))


def brute(rows, labels):
    def fails(k, t):
        w = WORD.findall(t)
        seen = k is not None and any(i is not None and i < k and (x or "") == t for i, x, *_ in rows)
        return {f for f, v in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t), seen)) if v}

    docs = [(s or "", fails(k, t or ""), k) for k, t, _, s, *_ in rows]
    best = {k: (max(q for i, q, _ in labels if i == k), max(x for i, _, x in labels if i == k)) for k, *_ in labels if k is not None}
    out = {}
    for part in {p for p, *_ in docs}:
        own = [(f, best.get(k, (0, 0))) for p, f, k in docs if p == part]
        removed_by = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own), sum(m[0] == 1 for _, m in gone), sum(m[1] == 1 for _, m in gone), f,
                ]
        for (p, _, _), v in out.items():
            if p == part:
                v[-1] = removed_by[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_all_orders_applied_in_turn(spark):
    rng = random.Random(4)
    rows = awkward()
    texts = ["A B C " * 30, "plain words only " * 10, "with # sign", "Upper CASE Text " * 20, "x y z", None, "", " ".join(f"word{i}" for i in range(80)), " ".join(f"W{i}" for i in range(80))]
    rows += [(400 + i, rng.choice(texts), "en", rng.choice(["s1", "s2", None, ""]), 0, 0, 0.0, "k") for i in range(120)]
    rows += [(450, "x y z", "en", "s9", 0, 0, 0.0, "k"), (None, "x y z", "en", "s9", 0, 0, 0.0, "k")]
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 520, 2)] + [(400, 1, 1), (None, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in M.audit(frame(spark, rows).repartition(4), marks).collect()}
    want = brute(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, _, s, *_ in rows}) and got == want


def test_audit_of_nothing(spark):
    assert M.audit(empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    assert M.build(empty(spark)).rows.count() == M.build(empty(spark)).words.count() == 0


def test_clean_up_deletes_what_a_run_has_made(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from stationcast.llm import support

    monkeypatch.setattr(support, "_MADE", [])
    counts = M.row_totals(M.build(frame(spark, awkward()))).select("n_words").toPandas()
    made = [Path(p.removeprefix("file://").removeprefix("file:")) for p in support._MADE]
    assert len(made) == 4 and all(p.exists() for p in made) and len(counts)
    assert support.clean_up(spark) == 4 and not any(p.exists() for p in made) and support.clean_up(spark) == 0


def test_a_closed_shard_lets_go_of_its_words(monkeypatch, tmp_path):
    """While the words of a shard go out, its dictionary and cells are not held any more."""
    import pyarrow as pa

    made = []

    class Watched(M.Shard):
        def __init__(self):
            super().__init__()
            made.append(self)

    monkeypatch.setattr(M, "Shard", Watched)
    monkeypatch.setattr(M, "PIECE", 20)
    docs = pa.RecordBatch.from_pydict({"c0": list(range(40)), "text": [f"a{i} b{i % 7} c a{i}" for i in range(40)]})
    out = M._shards(str(tmp_path), 50, 4)(iter([docs]))
    for k, _ in enumerate(out):
        held = [s for s in made if s.known is not None or s.cells or s.words]
        assert len(held) <= 1  # the one that is being filled
    assert len(made) > 2 and k >= len(made) - 1 and not any(s.words for s in made)
