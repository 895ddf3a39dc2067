"""Token counts of whole texts by overlap resynchronisation.

Texts of up to `segment` characters are encoded as they are. A longer one is cut into segments that may lie in different
tasks; each is encoded on its own, together with the first `overlap` characters of the next. In that overlap the two
encodings are spliced at a token that both hold.

Why this is exact. Byte-pair merges by a fixed priority (score of the merged piece, then the leftmost) give a sequence of
tokens exactly when each two neighbours, encoded alone, stay those two: before the first merge across a token boundary all
tokens grow independently of each other, so that merge would also take place in the two tokens on their own. Take the
left segment's tokens up to the end of a shared token and the right segment's after it: every two neighbours stand next to
each other in one of the two encodings, so the spliced sequence is that of the whole text. A boundary that both share is
not enough, a token that both share is. What the library puts before a text (its blank) is never part of a shared token.

Where an overlap holds no shared token, it is widened `WIDER`-fold and both segments are encoded again; once it would pass
the next segment, the two become one. Only such segments are read again, so in the end every text is exact, at worst
(a text without any alignment) as one segment.

The model must be a BPE model that leaves characters as they are (checked with a probe) and may fall back to bytes.

Rows: one per document. Null and empty texts have no token. Repeated rows and null keys are counted row by row. An empty
table gives no row. Only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow, per_process, runs, written

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SEGMENT, OVERLAP, WIDER = 1 << 15, 256, 16
_PROBE = "A  ﬁ① é\tＡ "

_SLICES_AT_ONCE = 64

_LONGS = pa.list_(pa.int64())
_SLICES = ["key", "n_bytes", "n_tokens", "doc", "no", "final", "slice"]
_SEGMENT = {"doc": pa.string(), "first": pa.int64(), "last": pa.int64(), "head": pa.int64(), "reach": pa.int64(), "final": pa.bool_()}
_CODED = pa.schema(_SEGMENT | {"start": pa.int64(), "tokens": pa.int64(), "head_ends": _LONGS, "head_counts": _LONGS, "tail_ends": _LONGS, "tail_counts": _LONGS})
_JUNCTION = pa.schema({"doc": pa.string(), "first": pa.int64(), "next": pa.int64(), "twice": pa.int64(), "wide": pa.int64()})


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Counter:
    """A model with the number of characters that each of its pieces covers."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        if m.decode(m.encode(_PROBE)) != _PROBE:
            raise ValueError(f"{path} changes the characters of a text")
        # of a character's byte pieces, the lead has length one and the others none
        self.sizes = np.array(
            [int(not 0x80 <= int(m.id_to_piece(i)[3:5], 16) < 0xC0) if m.is_byte(i) else len(m.id_to_piece(i)) for i in range(m.get_piece_size())], np.int64
        )

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in characters of the text; the blank before a text has none of them."""
        return np.cumsum(self.sizes[self.model.encode(text)]) - 1


def counter(path: str) -> Counter:
    return per_process(f"counter:{path}", lambda: Counter(path))


def counts_at(ends: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct token ends from `low` to `high`, and the number of tokens up to each."""
    last = np.flatnonzero(np.append(np.diff(ends) > 0, True)) if len(ends) else np.empty(0, np.int64)
    last = last[(ends[last] >= low) & (ends[last] <= high)]
    return ends[last], last + 1


def splice(a_ends, a_counts, b_ends, b_counts, least: int) -> tuple[int, int] | None:
    """Tokens of the left and of the right encoding up to the end of the first token that begins at `least` or later
    in both; None if there is none."""
    both, at, bt = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    shared = np.flatnonzero((np.diff(at) == 1) & (np.diff(bt) == 1) & (both[:-1] >= least))
    if not len(shared):
        return None
    k = shared[0] + 1
    return int(a_counts[at[k]]), int(b_counts[bt[k]])


def _first_pass(path: str, segment: int, overlap: int):
    """Counts short texts; cuts long ones into slices, each with the overlap behind it."""
    def rows(keys, n_bytes, n_tokens, doc, no, final, slices):
        columns = [pa.array(x, t) for x, t in zip((n_bytes, n_tokens, doc, no, final, slices), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()))]
        return pa.RecordBatch.from_arrays([keys, *columns], names=_SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            fits = pc.less_equal(pc.fill_null(pc.utf8_length(texts), 0), segment).to_numpy(zero_copy_only=False)
            short, none = pa.array(np.flatnonzero(fits)), [None] * int(fits.sum())
            part = texts.take(short)
            tokens = [n for some in runs(x.as_py() for x in part) for n in counter(path).counts(some)]
            yield rows(keys.take(short), pc.fill_null(pc.binary_length(part), 0), tokens, none, none, none, none)
            for i in np.flatnonzero(~fits).tolist():
                text, doc = texts[i].as_py(), uuid.uuid4().hex
                n_bytes, count = len(text.encode()), -(-(len(text) - overlap) // segment)
                for a in range(0, count, _SLICES_AT_ONCE):
                    no = range(a, min(a + _SLICES_AT_ONCE, count))
                    cut = [text[k * segment : (k + 1) * segment + overlap] for k in no]
                    yield rows(keys.take(pa.array([i] * len(no))), [n_bytes] * len(no), [None] * len(no), [doc] * len(no), list(no), [k == count - 1 for k in no], cut)

    return run


def _encode(path: str, segment: int, schema: pa.Schema):
    """Rows (_SEGMENT, pieces: the stored slices from `first` on) to rows of _CODED."""
    def text_of(r: dict) -> str:
        slices = [p["text"] for p in sorted(r["pieces"], key=lambda p: p["no"])]
        inside = r["last"] - r["first"] + 1
        whole = slices if r["final"] else slices[: inside + 1]
        text = "".join(s[:segment] for s in whole[:-1]) + whole[-1]
        return text if r["final"] else text[: inside * segment + r["reach"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                start, stop = r["first"] * segment, (r["last"] + 1) * segment
                ends = counter(path).ends(text_of(r)) + start
                head = counts_at(ends, start, start + r["head"]) if r["first"] else ([], [])
                tail = ([], []) if r["final"] else counts_at(ends, stop, stop + r["reach"])
                del r["pieces"]
                rows.append(r | {"start": start, "tokens": len(ends), "head_ends": head[0], "head_counts": head[1], "tail_ends": tail[0], "tail_counts": tail[1]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _junctions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours to the number of tokens that both have counted; null where they share none."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            found = splice(*(np.array(r[c], np.int64) for c in ("tail_ends", "tail_counts", "head_ends", "head_counts")), r["start"])
            rows.append({"doc": r["doc"], "first": r["first"], "next": r["next"], "twice": None if found is None else r["tokens"] - found[0] + found[1], "wide": r["wide"]})
        yield pa.RecordBatch.from_pylist(rows, schema=_JUNCTION)


def ddl_of(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", _LONGS: "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _coded(todo: DataFrame, slices: DataFrame, path: str, segment: int, overlap: int) -> DataFrame:
    """Encodes the segments of `todo`: their slices, and the one after them where a reach goes beyond the stored overlap."""
    upto = F.when(F.col("final") | (F.col("reach") <= overlap), F.col("last")).otherwise(F.col("last") + 1)
    rows = todo.withColumn("no", F.explode(F.sequence("first", upto))).join(slices.select("doc", "no", "slice"), ["doc", "no"])
    rows = rows.groupBy(*_SEGMENT).agg(F.collect_list(F.struct("no", F.col("slice").alias("text"))).alias("pieces"))
    return map_arrow(rows, _encode(path, segment, _CODED), ddl_of(_CODED))


def _next_plan(coded: DataFrame, failed: DataFrame, overlap: int, segment: int) -> DataFrame:
    """Segments of the next round, with `again` where they are to be encoded: a failed junction widens its two segments'
    overlap, or makes one segment of them once the overlap would pass a slice."""
    left = failed.select("doc", "first", F.lit(True).alias("fails"), "wide")
    right = failed.select("doc", F.col("next").alias("first"), F.lit(True).alias("failed"), F.col("wide").alias("was"))
    rows = coded.select("doc", "first", "last", "head", "reach", "final").join(left, ["doc", "first"], "left").join(right, ["doc", "first"], "left")
    wide, was = F.coalesce("fails", F.lit(False)), F.coalesce("failed", F.lit(False))
    rows = rows.withColumns({
        "merges": was & (F.col("was") * WIDER > segment), "again": wide | was,
        "reach": F.when(wide, F.least(F.col("reach") * WIDER, F.lit(segment))).otherwise(F.col("reach")),
        "head": F.when(was, F.least(F.col("head") * WIDER, F.lit(segment))).otherwise(F.col("head")),
    })
    rows = rows.withColumn("run", F.sum((~F.col("merges")).cast("long")).over(Window.partitionBy("doc").orderBy("first")))
    end, begin = F.max(F.struct("first", "last", "reach", "final")), F.min(F.struct("first", "head"))
    return rows.groupBy("doc", "run").agg(begin.alias("b"), end.alias("e"), F.max("again").alias("again")).select(
        "doc", "b.first", "e.last", "b.head", "e.reach", "e.final", "again"
    )


def count_tokens(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str | None = None, limit: int = LIMIT,
    segment: int = SEGMENT, overlap: int = OVERLAP,
) -> DataFrame:
    """Per document: key, n_bytes (UTF-8), n_tokens, over_limit (more than `limit`), segments (encoded apart, in the end)."""
    if not 0 < overlap <= segment:
        raise ValueError("an overlap is at most a segment")
    path, kind = os.path.abspath(model or default_path()), docs.schema[key].dataType.simpleString()
    ddl = f"key {kind}, n_bytes long, n_tokens long, doc string, no long, final boolean, slice string"
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    first = written(map_arrow(rows, _first_pass(path, segment, overlap), ddl), "token-slices")
    over = (F.col("n_tokens") > limit).alias("over_limit")
    short = first.filter("doc IS NULL").select("key", "n_bytes", "n_tokens", F.lit(1).cast("long").alias("segments"))
    slices = first.filter("doc IS NOT NULL")
    wide, piece = F.lit(overlap).cast("long"), F.array(F.struct("no", F.col("slice").alias("text"))).alias("pieces")
    plan = slices.select("doc", F.col("no").alias("first"), F.col("no").alias("last"), wide.alias("head"), wide.alias("reach"), "final", piece)
    coded = written(map_arrow(plan.repartition("doc", "first"), _encode(path, segment, _CODED), ddl_of(_CODED)), "token-segments")
    while True:
        after = coded.select("doc", F.col("first").alias("next"), "start", "head_ends", "head_counts")
        before = coded.filter("NOT final").select("doc", "first", (F.col("last") + 1).alias("next"), "tokens", "tail_ends", "tail_counts", F.col("reach").alias("wide"))
        pairs = before.join(after, ["doc", "next"])
        junctions = written(map_arrow(pairs, _junctions, ddl_of(_JUNCTION)), "token-junctions")
        failed = junctions.filter("twice IS NULL")
        if failed.isEmpty():
            break
        plan = written(_next_plan(coded, failed, overlap, segment), "token-plan")
        fresh = _coded(plan.filter("again").drop("again"), slices, path, segment, overlap)
        kept = coded.join(plan.filter("NOT again").select("doc", "first"), ["doc", "first"], "left_semi")
        coded = written(fresh.unionByName(kept), "token-segments")
    parts = coded.select("doc", "tokens", F.lit(1).alias("segment")).unionByName(junctions.select("doc", (-F.col("twice")).alias("tokens"), F.lit(0).alias("segment")))
    totals = parts.groupBy("doc").agg(F.sum("tokens").alias("n_tokens"), F.sum("segment").alias("segments"))
    long = slices.filter("no = 0").select("doc", "key", "n_bytes").join(totals, "doc").select("key", "n_bytes", "n_tokens", "segments")
    return short.unionByName(long).select(F.col("key").alias(key), "n_bytes", "n_tokens", over, "segments")
