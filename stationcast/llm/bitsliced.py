"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers, floor(scale * x). The rows are dealt into blocks; a block's index holds, for each
dimension and each bit of the offset value, a bitmap over its rows. For a query the bitmaps are added up with bitmap
arithmetic: the value of dimension d counts once for each set bit of the query's component (complemented where that is
negative), carry-save adders turn the bitmaps of one significance into one and carry to the next, and what is left
is the score's own bit slices. From the most significant slice downward the rows are split into certain and boundary
ones until `k` are certain; the boundary's ties go to the smaller identifier, and the rows found get their score
from their stored components, exactly.

A block of the index is written once, in the shared folder, and stays there: a task is given the number of a block and that
of a group of queries, opens the one, and streams the others past it. There are as many groups as keep the cluster busy; with
many blocks that is one, so that the index is read once. Each task gives `k` rows a query, and the last step ranks those.
All queries meet all rows.

Vectors with a component of 2^26 or more, once quantised, would make slices of hundreds of bits. They take a side path that
multiplies in integers of any length: as queries against all rows, as candidates against all queries, streamed the same way.
Both paths' rows are ranked together. A score beyond 64 bits is ranked by its exact value and given as the nearest long.

Defined results: vectors that are null, or hold null, NaN or infinite components, take no part; shorter vectors count as
filled up with zeros; rows with equal identifier and quantised vector are copies, each a candidate
of its own, and answer as one query, which leaves out one copy of itself; a null identifier is no query and comes last
in ties; other columns are not read; an empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.support import file_system, map_arrow, scratch, written

SCALE = 256
LARGEST = 1 << 26
#: Rows of an index block, and queries of a query block.
BLOCK_ROWS = 1 << 16
QUERY_ROWS = 64
#: Rows of any length that meet a batch of queries at once.
LONG_ROWS = 256
NO_ID = np.iinfo(np.int64).max


def taking_part(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def is_short(vector: str, scale: int) -> Column:
    """Whether the quantised components fit the index."""
    return F.forall(vector, lambda x: F.abs(x.cast("double")) * float(scale) < float(LARGEST))


def exact_component(x: float, scale: int) -> int:
    """floor(scale * x), also where the product is beyond a double's range."""
    return math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale


def sort_key(score: Column) -> Column:
    """A text that sorts as the integer, given as text, does."""
    digits = F.regexp_replace(score, "^-", "")
    up = F.concat(F.lit("1"), F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
    down = F.concat(F.lit("0"), F.lpad((999_999 - F.length(digits)).cast("string"), 6, "0"), F.translate(digits, "0123456789", "9876543210"))
    return F.when(score.startswith("-"), down).otherwise(up)


# ---------------------------------------------------------------- bitmaps

def slices_of(values: np.ndarray, bits: int) -> np.ndarray:
    """[dimension, bit, word] bitmaps of the offset values; values: [row, dimension]."""
    rows, dims = values.shape
    words = max(1, -(-rows // 64))
    offset = (values.astype(np.int64) + (1 << (bits - 1))).T
    out = np.zeros((dims, bits, words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((offset >> b & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, b, : packed.shape[1]] = packed
    return out.view(np.uint64)


def score_slices(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """(bit slices of the non-negative sums, lowest first; what to add to a sum to get the score)."""
    dims, bits, words = slices.shape
    shift, add = 0, 0
    columns: dict[int, list[np.ndarray]] = {}
    mags = np.abs(query)
    for w in query[query != 0].tolist():
        add += -w * (1 << (bits - 1)) if w > 0 else w * ((1 << (bits - 1)) - 1)
    top = int(mags.max(initial=0)).bit_length()
    for c in range(top):
        on = (mags >> c) & 1 == 1
        up, down = np.flatnonzero(on & (query > 0)), np.flatnonzero(on & (query < 0))
        for b in range(bits):
            parts = [slices[up, b]] * bool(len(up)) + [~slices[down, b]] * bool(len(down))
            if parts:
                columns.setdefault(c + b, []).extend(parts)
    out: list[np.ndarray] = []
    while shift <= max(columns, default=-1):
        parts = columns.pop(shift, [])
        stack = np.concatenate(parts) if parts else np.zeros((0, words), np.uint64)
        carries = []
        while len(stack) > 2:
            n = len(stack) // 3
            a, b, c = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            stack = np.concatenate([half ^ c, stack[3 * n :]])
        if len(stack) == 2:
            carries.append((stack[:1] & stack[1:]))
            stack = stack[:1] ^ stack[1:]
        if carries:
            columns.setdefault(shift + 1, []).extend(carries)
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        shift += 1
    return out, add


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(sums: list[np.ndarray], open_rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap of rows that are certainly among the k largest, bitmap of rows tied at the boundary)."""
    sure, edge, have = np.zeros_like(open_rows), open_rows.copy(), 0
    for bits in reversed(sums):
        high = edge & bits
        n = int(np.bitwise_count(high).sum())
        if have + n > k:
            edge = high
        else:
            sure, edge, have = sure | high, edge & ~bits, have + n
            if have == k:
                return sure, np.zeros_like(edge)
    return sure, edge


def block_top(values: np.ndarray, slices: np.ndarray, ids: np.ndarray, copies: np.ndarray, query: np.ndarray, query_id: int, k: int):
    """(rows, scores, the query's own row if it is here) of one block for one query, without one copy of itself."""
    rows = len(ids)
    open_rows = np.zeros(slices.shape[2] * 8, np.uint8)
    filled = np.packbits(np.ones(rows, np.uint8), bitorder="little")
    open_rows[: len(filled)] = filled
    own = np.flatnonzero(ids == query_id)
    own = own[(values[own] == query).all(axis=1)] if len(own) else own
    for r in own[copies[own] == 1]:
        open_rows[r // 8] &= ~np.uint8(1 << r % 8)
    open_rows = open_rows.view(np.uint64)
    sums, _ = score_slices(slices, query)
    sure, edge = top_rows(sums, open_rows, k)
    found, tied = rows_of(sure), rows_of(edge)
    left = k - len(found)
    if left > 0 and len(tied) > left:
        tied = tied[np.argpartition(ids[tied], left - 1)[:left]]
    found = np.concatenate([found, tied[: max(left, 0)]])
    return found, values[found].astype(np.int64) @ query, own


# ---------------------------------------------------------------- Spark

def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build_index(rows: DataFrame, dims: int, bits: int, blocks: int) -> DataFrame:
    """A row per block: block, rows, ids, copies, values, bitmaps (binary). rows: vec_id, v, copies."""
    kind = np.int16 if bits <= 16 else np.int32

    def build(group: pd.DataFrame) -> pd.DataFrame:
        values = _matrix(group["v"], dims)
        ids = group["vec_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
        return pd.DataFrame([{
            "block": int(group["block"].iloc[0]), "ids": ids.tobytes(), "copies": group["copies"].to_numpy(np.int64).tobytes(),
            "values": values.astype(kind).tobytes(), "bitmaps": slices_of(values, bits).tobytes(),
        }])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(build, "block long, ids binary, copies binary, values binary, bitmaps binary")


def _stored(path: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a table, or of one partition of it, that Spark has written; none where there is no such partition."""
    from pyarrow import dataset, fs

    files, at = file_system(path)
    if files.get_file_info(at).type != fs.FileType.NotFound:
        yield from dataset.dataset(at, filesystem=files, format="parquet").to_batches(columns=columns)


def _short_answers(blocks: int, bits: int, dims: int, index: str, queries: str, k: int):
    kind = np.int16 if bits <= 16 else np.int32

    def answer(block: int, group: int) -> Iterator[pa.RecordBatch]:
        for stored in _stored(f"{index}/block={block}", ["ids", "copies", "values", "bitmaps"]):
            ids, copies, values, bitmaps = (memoryview(c[0].as_buffer()) for c in stored.columns)
            ids, copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
            values = np.frombuffer(values, kind).reshape(len(ids), dims)
            slices = np.frombuffer(bitmaps, np.uint64).reshape(dims, bits, -1)
            for some in _stored(f"{queries}/part={group}", ["qids", "qrows", "queries"]):
                for r in range(some.num_rows):
                    qids, qrows, asked = (np.frombuffer(c[r].as_buffer(), np.int64) for c in some.columns)
                    out = [[], [], [], [], []]
                    for q, qid, qrow in zip(asked.reshape(len(qids), dims), qids, qrows):
                        found, scores, own = block_top(values, slices, ids, copies, q, int(qid), k)
                        n = copies[found] - np.isin(found, own)
                        for part, x in zip(out, (np.full(len(found), qid), np.full(len(found), qrow), ids[found], scores, np.minimum(n, k))):
                            part.append(x)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], ["query_id", "qrow", "vec_id", "score", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.column(0).to_pylist():
                yield from answer(pair % blocks, pair // blocks)

    return run


def _long_answers(queries: str, k: int):
    """Candidates (vec_id, w: integers as texts, copies) to the `k` best of each of their blocks for every stored query."""
    def matrix(vectors: list[list[str]]) -> list[list[int]]:
        return [list(map(int, v)) for v in vectors]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, LONG_ROWS):
                batch = whole.slice(i, LONG_ROWS)
                ids, rows, copies = batch.column(0).to_pylist(), matrix(batch.column(1).to_pylist()), batch.column(2).to_pylist()
                for some in _stored(queries, ["vec_id", "qrow", "w"]):
                    out = []
                    for qid, qrow, q in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), matrix(some.column(2).to_pylist())):
                        scored = []
                        for key, v, n in zip(ids, rows, copies):
                            n -= key == qid and v == q
                            if n:
                                scored.append((-sum(map(int.__mul__, q, v)), key is None, key or 0, min(n, k)))
                        for score, none, key, n in sorted(scored)[:k]:
                            out.append({"query_id": qid, "qrow": qrow, "vec_id": int(NO_ID) if none else key, "exact": str(-score), "n": n})
                    yield pa.RecordBatch.from_pylist(out, schema=_LONG)

    return run


_LONG = pa.schema([("query_id", pa.int64()), ("qrow", pa.int64()), ("vec_id", pa.int64()), ("exact", pa.string()), ("n", pa.int64())])


def top_k(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by `every`, the `k` other rows with the largest
    inner products."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("x")).filter(taking_part("x"))
    short = given.filter(is_short("x", scale)).select("vec_id", F.transform("x", lambda x: F.floor(x.cast("double") * float(scale))).alias("v"))
    rows = written(short.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")), "topk-rows")
    asked = F.col("vec_id") % every == 0
    count, queries, dims, largest = rows.agg(
        F.count(F.lit(1)), F.count_if(asked), F.coalesce(F.max(F.size("v")), F.lit(0)),
        F.coalesce(F.max(F.greatest(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0))), F.lit(0)),
    ).first()
    dims, bits = max(dims, 1), int(largest).bit_length() + 1
    blocks, query_blocks = max(1, -(-count // block_rows)), max(1, -(-queries // query_rows))
    parts = min(query_blocks, max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    index_path, query_path = scratch(spark, "topk-index"), scratch(spark, "topk-queries")
    build_index(rows, dims, bits, blocks).write.partitionBy("block").parquet(index_path)

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{
            "part": int(group["qblock"].iloc[0]) % parts, "qids": group["vec_id"].to_numpy(np.int64).tobytes(),
            "qrows": group["qrow"].to_numpy(np.int64).tobytes(), "queries": _matrix(group["v"], dims).tobytes(),
        }])

    wanted = rows.filter(asked).withColumn("qrow", F.xxhash64("vec_id", "v"))
    dealt = wanted.withColumn("qblock", F.pmod("qrow", F.lit(query_blocks)))
    dealt.groupBy("qblock").applyInPandas(gather, "part long, qids binary, qrows binary, queries binary").write.partitionBy("part").parquet(query_path)
    pairs = spark.range(0, blocks * parts, 1, min(blocks * parts, 1 << 16))
    found = map_arrow(pairs, _short_answers(blocks, bits, dims, index_path, query_path, k), "query_id long, qrow long, vec_id long, score long, n long")
    best = [F.col("score").desc(), "vec_id"]

    def as_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [[str(exact_component(x, scale)) for x in v] for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.list_(pa.string()))], ["vec_id", "w"])

    long = given.filter(~is_short("x", scale)).select("vec_id", F.transform("x", lambda x: x.cast("double")).alias("x"))
    long = written(map_arrow(long, as_texts, "vec_id long, w array<string>").groupBy("vec_id", "w").agg(F.count(F.lit(1)).alias("copies")), "topk-long")
    if not long.isEmpty():
        same = rows.select("vec_id", F.transform("v", lambda x: x.cast("string")).alias("w"), "copies")
        # components that are not there are zeros: all vectors get the same number of them
        width = max(dims, long.agg(F.max(F.size("w"))).first()[0])
        filled = F.concat("w", F.array_repeat(F.lit("0"), F.lit(width) - F.size("w")))
        long_asked, short_asked = scratch(spark, "topk-asked"), scratch(spark, "topk-asked")
        long.filter(asked).select("vec_id", F.xxhash64("vec_id", "w").alias("qrow"), filled.alias("w")).write.parquet(long_asked)
        wanted.select("vec_id", "qrow", F.transform("v", lambda x: x.cast("string")).alias("w")).withColumn("w", filled).write.parquet(short_asked)
        ddl = "query_id long, qrow long, vec_id long, exact string, n long"
        candidates = [long.withColumn("w", filled), same.withColumn("w", filled)]
        beyond = [map_arrow(c, _long_answers(p, k), ddl) for c, p in ((candidates[0], long_asked), (candidates[1], long_asked), (candidates[0], short_asked))]
        found = found.withColumn("exact", F.col("score").cast("string")).drop("score")
        for more in beyond:
            found = found.unionByName(more)
        nearest = F.when(F.col("exact").startswith("-"), -(2**63)).otherwise(2**63 - 1)
        found = found.withColumn("score", F.coalesce(F.expr("try_cast(exact AS long)"), nearest))
        best = [sort_key(F.col("exact")).desc(), "vec_id"]
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "qrow").orderBy(*best))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(int(NO_ID))).alias("vec_id"), "score")
