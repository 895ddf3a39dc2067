"""Toxic passages as maximum-scoring segments, and a toxicity score per document.

Learning, on a bounded sample of labelled rows (`sample` rows at most, the same on each run; never a held-out row):
copies are thinned to one row per smallest shingle hash, then each feature (a word, or the first 4 to 7 bytes of
longer ones) is counted in toxic and clean texts. Its weight is the difference of the log-odds with a Dirichlet prior
proportional to the feature's overall rate, above zero or below. Features count whose surplus in toxic texts is no
chance finding among all features (Chernoff bound below `chance` divided by the number of features), and those whose
surplus in clean texts is none by itself (bound below `doubt`: a word that counts as clean by chance reports nothing);
of several in a word the one farthest from zero does. A word of which the sample tells neither costs `gap`.

Scoring, on every whole text in its row: the maximal-scoring segments of the sequence of word weights (Ruzzo and
Tompa's linear scan) are the passages; each occurrence of a word has its full weight. By extreme-value theory a passage
of score S in a text of n words has E = n exp(-lambda S), lambda being the solution of sum p exp(lambda s) = 1 over the
clean word rates. Passages with E below `significant` are reported. A text's evidence is the tail probability of the sum
of their normalised scores, for which the n-th use of a word within the text's passages weighs 1 / n^2 of the first (a
text that repeats itself says a thing once), and a logistic curve fitted on the sample turns its logarithm into the score.

Inputs of a score are the text's words alone. Defined results: null and empty texts have no passage and get the
score of texts without evidence; equal texts get equal scores; labels without a text are ignored; of repeated label
rows the toxic one counts; without any label nothing is toxic; a null
document id counts as held out; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow, written

#: Labelled rows that the model may be fitted on.
SAMPLE = 20_000
FOLDS = 5
PRIOR = 10.0
CHANCE = 0.01
DOUBT = 0.05
GAP = 0.02
SIGNIFICANT = 0.01
STEMS = (4, 5, 6, 7)

#: Bytes that end a word: ASCII other than letters, digits and the apostrophe. Characters beyond ASCII stay.
_BREAK = bytes(c if c >= 128 or chr(c).isalnum() or c == 39 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BREAK).split()


def stems_of(word: bytes) -> list[bytes]:
    """The first letters of longer words, marked by a star."""
    return [word[:n] + b"*" for n in STEMS if len(word) > n]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


# ---------------------------------------------------------------- segments

def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a sequence, in order; Ruzzo and Tompa's algorithm."""
    found: list[tuple[int, int, float, float]] = []  # start, end, total before, total after
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low = i, before
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= total:
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
        found.append((start, i + 1, low, total))
    return [(a, b, r - l) for a, b, l, r in found]


@dataclass(frozen=True)
class Model:
    """weights: of significant features; decay: lambda; curve: intercept and slope over -log10 of the tail."""

    weights: dict[bytes, float] = field(default_factory=dict)
    decay: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)
    gap: float = GAP
    significant: float = SIGNIFICANT

    def weight(self, word: bytes) -> float:
        found = [self.weights[f] for f in (word, *stems_of(word)) if f in self.weights]
        return max(found, key=lambda x: (abs(x), x)) if found else 0.0

    def _learnt(self, word: bytes, known: dict[bytes, float]) -> float:
        known[word] = self.weight(word) or -self.gap
        return known[word]

    def passages(self, text: str | None, known: dict[bytes, float]) -> tuple[int, list[tuple[int, int, float, float]]]:
        """(words, significant passages as first word, end, score, E). known: scores of words seen before."""
        words = words_of(text)
        scores, places, cost = [], [], 0.0
        for i, w in enumerate(words):
            s = known.get(w)
            if s is None:
                s = self._learnt(w, known)
            if s <= 0:
                cost += s
                continue
            if cost and scores:  # what the words between cost together
                scores.append(cost)
                places.append(i)
            cost = 0.0
            scores.append(s)
            places.append(i)
        n, out = len(words), []
        for a, b, score in maximal_segments(scores):
            expected = n * math.exp(-self.decay * score)
            if expected <= self.significant:
                out.append((places[a], places[b - 1] + 1, score, expected))
        return n, out

    def tempered(self, text: str | None, passages: list[tuple[int, int, float, float]], known: dict[bytes, float]) -> list[tuple[int, int, float, float]]:
        """The passages with the score of their best part when the n-th use of a word in them weighs 1 / n^2."""
        words, times, out = words_of(text) if passages else [], {}, []
        for first, last, _, expected in passages:
            scores = []
            for w in words[first:last]:
                s = known[w] if w in known else self._learnt(w, known)
                if s > 0:
                    n = times[w] = times.get(w, 0) + 1
                    s /= n * n
                scores.append(s)
            out.append((first, last, max(s for *_, s in maximal_segments(scores)), expected))
        return out

    def evidence(self, n: int, passages: list[tuple[int, int, float, float]]) -> float:
        """-log10 of the probability that a clean text's r best passages sum up to this."""
        parts = [x for x in (self.decay * s - math.log(n) for _, _, s, _ in passages) if x > 0]
        if not parts:
            return 0.0
        r, total = len(parts), sum(parts)
        tail = -total + (r - 1) * math.log(max(total, 1.0)) - math.lgamma(r + 1) - math.lgamma(r)
        return max(0.0, -tail / math.log(10))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.curve[0] + self.curve[1] * evidence))))


# ---------------------------------------------------------------- learning

def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic) once per text, from (toxic, text)."""
    for batch in batches:
        for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = {f for w in set(words_of(text)) for f in (w, *stems_of(w))}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([toxic] * len(found), pa.int32())], ["feature", "toxic"])


def _shingle_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, toxic, text): the smallest hash of a text's three-word windows."""
    import xxhash

    for batch in batches:
        keys = []
        for text in batch.column(1).to_pylist():
            w = words_of(text)
            keys.append(min((xxhash.xxh3_64_intdigest(b" ".join(x)) for x in zip(w, w[1:], w[2:])), default=xxhash.xxh3_64_intdigest(b" ".join(w))) >> 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *batch.columns], ["key", "toxic", "text"])


def _tally(model: Model):
    """(toxic, weight, words) from (toxic, text): how many words of the texts have which weight, 0 being all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, float], int] = {}
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                for w in words_of(text):
                    key = toxic, model.weight(w)
                    counts[key] = counts.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in counts], pa.int32()), pa.array([w for _, w in counts], pa.float64()), pa.array(list(counts.values()), pa.int64())],
            ["toxic", "weight", "words"],
        )

    return run


def _decay(rates: dict[float, float], gap: float) -> float:
    """The positive solution of sum p exp(lambda s) = 1, for the rates p of the weights s of either sign; all other words score -gap."""
    s, p = np.array([*rates, -gap]), np.array([*rates.values(), 0.0])
    p[-1] = max(1.0 - p.sum(), 1e-9)
    if (p * s).sum() >= 0:
        return 1e-3
    low, high = 1e-6, 20.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 600))).sum() < 1 else (low, mid)
    return low


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression of y on x with a small ridge, by Newton steps."""
    scale = max(float(x.max(initial=0.0)), 1.0)
    design, beta = np.stack([np.ones(len(x)), np.minimum(x / min(scale, 10.0), 1.0)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2), design.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1] / min(scale, 10.0))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """toxic, text of at most `sample` labelled rows, chosen by a hash of their id. The ids are a table of bounded
    size, so the documents are not shuffled."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxicity-ids")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    return rows


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, prior: float = PRIOR, chance: float = CHANCE, doubt: float = DOUBT, gap: float = GAP) -> Model:
    """Fits the model; what reaches the driver is bounded by the sample."""
    rows = map_arrow(training_rows(docs, labels, sample), _shingle_key, "key long, toxic int, text string")
    rows = written(rows.groupBy("key", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"), "toxicity-sample")
    n1, n0 = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not n1 or not n0:
        return Model(curve=(math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else -1.0, 0.0), gap=gap)
    counted = map_arrow(rows, _features, "feature binary, toxic int").groupBy("feature").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b")
    )
    counted = written(counted, "toxicity-features")
    features = counted.count()
    share, a, b = n1 / (n1 + n0), F.col("a").cast("double"), F.col("b").cast("double")
    surplus = sum(F.when(x > 0, x * F.ln(x / ((a + b) * part))).otherwise(0.0) for x, part in ((a, share), (b, 1 - share)))
    significant = counted.filter(surplus >= F.when(a > (a + b) * share, math.log(features / chance)).otherwise(-math.log(doubt)))
    weights = {}
    for r in significant.collect():  # a subset of the sample's features
        extra = prior * (r.a + r.b) / (n1 + n0)
        odds = lambda x, n: math.log((x + extra) / max(n + prior - x - extra, 0.5))
        weights[bytes(r.feature)] = odds(r.a, n1) - odds(r.b, n0)
    model = Model(weights, gap=gap)
    if not any(w > 0 for w in weights.values()):
        return Model(curve=(math.log((n1 + 0.5) / (n0 + 0.5)), 0.0), gap=gap)
    tally = map_arrow(rows, _tally(model), "toxic int, weight double, words long").groupBy("toxic", "weight").agg(F.sum("words").alias("words"))
    words: tuple[dict, dict] = ({}, {})
    for r in tally.collect():  # a row per class and weight
        words[r.toxic][r.weight] = r.words
    clean, toxic = (max(sum(x.values()), 1) for x in words)
    # the clean rate of a weight, with the prior spread as toxic texts have it
    rates = {w: (words[0].get(w, 0) + prior * words[1].get(w, 0) / toxic) / (clean + prior) for w in {*words[0], *words[1]} if w}
    model = Model(model.weights, _decay(rates, gap), gap=gap)
    pairs = np.array([tuple(r) for r in scored(rows, model, keep=("toxic",)).select("evidence", "toxic").collect()], float).reshape(-1, 2)
    return Model(model.weights, model.decay, _curve(pairs[:, 0], pairs[:, 1]), gap)


# ---------------------------------------------------------------- scoring

KNOWN_WORDS = 200_000
PASSAGES = "array<struct<first:int,last:int,score:double,expected:double>>"


def scored(docs: DataFrame, model: Model, *, keep: tuple[str, ...], text: str = "text", prefix: str = "") -> DataFrame:
    """`keep`, passages (first word, word after the last, score, E), evidence and score, the latter under the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known.clear()
            spans, evidence = [], []
            for t in batch.column(len(keep)).to_pylist():
                n, found = model.passages(t, known)
                spans.append([{"first": a, "last": b, "score": s, "expected": e} for a, b, s, e in found])
                evidence.append(model.evidence(n, model.tempered(t, found, known)))
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(spans, kind), pa.array(evidence, pa.float64()),
                 pa.array([model.score(e) for e in evidence], pa.float64())],
                [*keep, f"{prefix}passages", f"{prefix}evidence", f"{prefix}score"],
            )

    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kept}, `{prefix}passages` {PASSAGES}, `{prefix}evidence` double, `{prefix}score` double")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    p = "__toxicity_"
    rows = scored(docs, learn(docs, labels), keep=tuple(docs.columns), prefix=p)
    return rows.filter(F.col(f"{p}score") < 0.5).select(*docs.columns)
