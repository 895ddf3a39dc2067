"""A sparse document-term matrix over the whole corpus, and the audit of filters that reads it.

`build` encodes words (maximal runs of anything but the blank and the five ASCII line and tab controls, case-sensitive) by one
dictionary for all documents, in three passes:
1. A task encodes its documents' words by a dictionary of its own, shard by shard (about `SHARD_WORDS` words each), and
   writes each shard as compressed sparse rows to a file: per document the terms in it and how often each occurs.
   Only the shard's distinct words leave the task, as one row for each bucket of words (by a hash) that it has any of.
2. A bucket's words from all shards meet; the bucket numbers its distinct words, and the buckets' counts give every word a
   dense global number. There are `BUCKETS` buckets for each partition of the input, so that a bucket stays small.
3. The numbers go back to the shards, again as one row for each shard and bucket. A task per shard reads its file, renames
   the terms and gives the rows with terms in ascending order; Spark writes them as the matrix. No document's words are ever
   shuffled.
In a column of arrays, the array's offsets and values are those of a CSR shard: `terms` holds the columns of a row's nonzeros,
`counts` their values. A row's sum is the number of words and its number of nonzeros that of distinct words.

`audit` takes five filters: A, under 50 words; B, 100 * distinct words < 65 * words; C, 100 * `[A-Z]` characters > 5 * code
points; D, any of `#$%&*|`; E, identical to the text of a smaller doc_id. A and B come from the matrix, the others are flags
that its rows carry. Documents are counted by part, failed filters and labels; the 120 orders are worked out on those counts.
Texts are compared by SHA-256.

Null texts are empty: no words, so A fails and B does not. Null and empty sources are one part. A null doc_id is no smaller
id, has none before it and no label. Repeated rows are documents of their own; rows of one doc_id are not before each other.
Of several labels of a doc_id the larger counts. An empty table gives no row. Words may be of any length; a
document longer than a shard is a shard of its own, split into pieces of `PIECE` characters on the way. `build` carries
the other columns of its input along unchanged, whatever their names.
"""

from __future__ import annotations

import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.support import file_system, map_arrow, open_file, scratch, with_prefix_sums, written
from stationcast.llm.tokens import PieceTable

SHARD_WORDS = 1 << 21
#: Buckets of words for each partition of the input.
BUCKETS = 4
PIECE = 1 << 21
_BLANK = re.compile(r"[\x20\x09-\x0D]")


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters, cut at blanks."""
    a = 0
    while len(text) - a > PIECE:
        cut = _BLANK.search(text, a + PIECE)
        if not cut:
            break
        yield text[a : cut.start()]
        a = cut.end()
    yield text[a:] if a else text


class Shard:
    """Documents' terms by a dictionary of their own."""

    def __init__(self):
        self.known = PieceTable()
        self.words: list[pa.LargeStringArray] = []  # by their numbers
        self.cells: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = self.uses = 0

    def add(self, texts: list[str], row: np.ndarray) -> None:
        """Words of texts that belong to the given rows; a row's texts may come in several calls."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        place = np.repeat(row, np.diff(lists.offsets.to_numpy()))
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary
        numbers = self.known.find(distinct)
        # beside blanks at either end the split gives empty words
        new = np.flatnonzero((numbers < 0) & (pc.binary_length(distinct).to_numpy() > 0))
        numbers[new] = np.arange(self.known.size, self.known.size + len(new))
        self.words.append(distinct.take(pa.array(new)))
        self.known.add(self.words[-1])
        local = numbers[coded.indices.to_numpy()]
        here = local >= 0
        cells, counts = np.unique(place[here] << 32 | local[here], return_counts=True)
        self.cells.append((cells, counts.astype(np.int32)))
        self.uses += int(here.sum())

    def csr(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets of the rows, terms and counts."""
        cells, counts = (np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*self.cells)) if self.cells else (np.empty(0, np.int64), np.empty(0, np.int64))
        if (np.diff(cells) <= 0).any():  # a row that came in pieces
            cells, back = np.unique(cells, return_inverse=True)
            counts = np.bincount(back, counts).astype(np.int64)
        offsets = np.zeros(self.rows + 1, np.int64)
        np.cumsum(np.bincount(cells >> 32, minlength=self.rows), out=offsets[1:])
        return offsets, cells & 0xFFFFFFFF, counts


def _csr_columns(offsets, terms, counts, kind: pa.DataType) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, t)) for x, t in ((terms, kind), (counts, pa.int32()))]


def bucket_of(words: pa.LargeStringArray, buckets: int) -> np.ndarray:
    """The same on every machine."""
    keys, short = PieceTable.keys_of(words)
    out = np.empty(len(words), np.uint64)
    out[short] = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    long = np.delete(np.arange(len(words)), short)
    out[long] = [zlib.crc32(w.encode()) for w in words.take(pa.array(long)).to_pylist()]
    out = (out ^ out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((out >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


_WORDS = pa.schema({"bucket": pa.int64(), "shard": pa.string(), "words": pa.string(), "terms": pa.binary()})


def _shards(folder: str, shard_words: int, buckets: int):
    """Documents (carried columns, text last) to the words of their shards by bucket, joined by line ends, with their terms.
    A shard without words has a row in bucket 0 all the same."""
    def close(shard: Shard, carried: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, name = pa.Table.from_batches(carried), uuid.uuid4().hex
        for column, values in zip(("_terms", "_counts"), _csr_columns(*shard.csr(), pa.int32())):
            table = table.append_column(column, values)
        fs, path = file_system(f"{folder}/{name}.arrow")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path, compression=None) as out, pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
            file.write_table(table, max_chunksize=4096)
        words = pa.concat_arrays(shard.words) if shard.words else pa.array([], pa.large_string())
        shard.known, shard.words, shard.cells = None, [], []  # the file has them
        del table
        pa.default_memory_pool().release_unused()
        if not len(words):
            yield pa.RecordBatch.from_pylist([{"bucket": 0, "shard": name, "words": "", "terms": b""}], schema=_WORDS)
            return
        of = bucket_of(words, buckets)
        order = np.argsort(of, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(of[order])) + 1, [len(of)]])
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), words.take(pa.array(order))), pa.scalar("\n", pa.large_string())).cast(pa.string())
        terms = order.astype(np.int32)
        for i in range(0, len(joined), 256):
            some = range(i, min(i + 256, len(joined)))
            yield pa.RecordBatch.from_arrays([
                pa.array(of[order[cuts[i : i + len(some)]]]), pa.array([name] * len(some)), joined.slice(i, len(some)),
                pa.array([terms[cuts[k] : cuts[k + 1]].tobytes() for k in some], pa.binary()),
            ], schema=_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, carried = Shard(), []
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rest = batch.select(range(batch.num_columns - 1))
            begun, part, rows, size = 0, [], [], 0
            for i in range(batch.num_rows):
                for piece in pieces(texts[i].as_py() or ""):
                    part.append(piece)
                    rows.append(shard.rows)
                    size += len(piece)
                    if size >= PIECE:
                        shard.add(part, np.array(rows, np.int64))
                        part, rows, size = [], [], 0
                shard.rows += 1
                if shard.uses >= shard_words or i == batch.num_rows - 1:
                    shard.add(part, np.array(rows, np.int64))
                    part, rows, size = [], [], 0
                    carried.append(rest.slice(begun, i + 1 - begun))
                    begun = i + 1
                    if shard.uses >= shard_words:
                        done, shard, kept, carried = shard, Shard(), carried, []
                        yield from close(done, kept)
                        del done, kept
                        pa.default_memory_pool().release_unused()
        if shard.rows:
            yield from close(shard, carried)
        del shard, carried
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks

    return run


_NUMBERED = pa.schema({"bucket": pa.int64(), "shard": pa.string(), "terms": pa.binary(), "numbers": pa.binary(), "words": pa.list_(pa.string()), "n": pa.int64()})


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _WORDS, bucket by bucket, to the number of each term within its bucket, and to the bucket's words."""
    def close(bucket: int, shards: list[str], words: list[str], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
        sizes = [len(t) // 4 for t in terms]
        full = pa.array([w for w, n in zip(words, sizes) if n], pa.large_string())
        coded = pc.split_pattern(full, "\n").flatten().dictionary_encode()
        numbers = coded.indices.to_numpy().astype(np.int32)
        ends = np.cumsum(sizes)
        rows = [{"bucket": bucket, "shard": s, "terms": t, "numbers": numbers[b - n : b].tobytes()} for s, t, n, b in zip(shards, terms, sizes, ends.tolist())]
        for i in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[i : i + 256], schema=_NUMBERED)
        n = len(coded.dictionary)
        own = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), coded.dictionary.cast(pa.string()))
        none = [pa.nulls(1, t) for t in (pa.string(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([bucket]), *none, own, pa.array([n])], schema=_NUMBERED)

    last, held = None, ([], [], [])
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != last:
                if last is not None:
                    yield from close(last, *held)
                last, held = bucket, ([], [], [])
            for column, value in zip(held, row):
                column.append(value)
    if last is not None:
        yield from close(last, *held)
    pa.default_memory_pool().release_unused()  # the worker stays for later tasks


def _renamed(folder: str, names: list[str]):
    """Rows (shard, base, terms, numbers), shard by shard, to the shard's rows with global terms."""
    def rows(shard: str, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        numbers = np.empty(sum(len(t) // 4 for _, t, _ in held), np.int64)
        for base, terms, own in held:
            numbers[np.frombuffer(terms, np.int32)] = base + np.frombuffer(own, np.int32).astype(np.int64)
        with open_file(f"{folder}/{shard}.arrow") as source:
            file = pa.ipc.open_file(source)
            for i in range(file.num_record_batches):
                batch = file.get_batch(i)
                terms, counts = batch.column("_terms"), batch.column("_counts")
                own, values = numbers[terms.flatten().to_numpy()], counts.flatten().to_numpy()
                offsets = terms.offsets.to_numpy() - terms.offsets[0].as_py()
                order = np.argsort(np.repeat(np.arange(batch.num_rows), np.diff(offsets)) << 44 | own)
                carried = [c for c, f in zip(batch.columns, batch.schema) if f.name not in ("_terms", "_counts")]
                yield pa.RecordBatch.from_arrays([*carried, *_csr_columns(offsets, own[order], values[order], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != last:
                    if last is not None:
                        yield from rows(last, held)
                    last, held = shard, []
                held.append(row)
        if last is not None:
            yield from rows(last, held)

    return run


class TermMatrix(NamedTuple):
    """rows: the carried columns, terms (ascending), counts. words: term, word."""

    rows: DataFrame
    words: DataFrame


def build(docs: DataFrame, *, text: str = "text", shard_words: int = SHARD_WORDS, buckets: int | None = None) -> TermMatrix:
    """The matrix of all documents. Columns of `docs` beside the text are carried along; `terms` and `counts` are added last
    (a carried column of such a name is called `terms_` or `counts_`)."""
    carried = [c for c in docs.columns if c != text]
    names = [f"{c}_" if c in ("terms", "counts") else c for c in carried]
    kinds = [docs.schema[c].dataType.simpleString() for c in carried]
    folder = scratch(docs.sparkSession, "term-shards")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{text}`").cast("string").alias("text"))
    buckets = buckets or BUCKETS * max(1, rows.rdd.getNumPartitions())
    words = written(map_arrow(rows, _shards(folder, shard_words, buckets), "bucket long, shard string, words string, terms binary"), "term-words")
    dealt = words.repartition("bucket").sortWithinPartitions("bucket")
    numbered = written(map_arrow(dealt, _numbered, "bucket long, shard string, terms binary, numbers binary, words array<string>, n long"), "term-numbers")
    counts = numbered.filter("shard IS NULL").select("bucket", "n")
    bases = with_prefix_sums(counts, "bucket", {"base": "n"}).select("bucket", "base")
    shards = numbered.filter("shard IS NOT NULL").join(bases, "bucket").select("shard", "base", "terms", "numbers")
    shards = shards.repartition("shard").sortWithinPartitions("shard")
    ddl = ", ".join([*(f"c{i} {k}" for i, k in enumerate(kinds)), "terms array<long>", "counts array<int>"])
    matrix = written(map_arrow(shards, _renamed(folder, [*(f"c{i}" for i in range(len(kinds))), "terms", "counts"]), ddl), "term-matrix", compression="zstd")
    vocabulary = numbered.filter("shard IS NULL").join(bases, "bucket").select("base", F.posexplode("words").alias("k", "word"))
    return TermMatrix(matrix.toDF(*names, "terms", "counts"), vocabulary.select((F.col("base") + F.col("k")).alias("term"), "word"))


def term_totals(matrix: TermMatrix) -> DataFrame:
    """term, documents that hold it, uses."""
    cells = matrix.rows.select(F.explode(F.arrays_zip("terms", "counts")).alias("c"))
    return cells.groupBy(F.col("c.terms").alias("term")).agg(F.count(F.lit(1)).alias("documents"), F.sum("c.counts").alias("uses"))


def row_totals(matrix: TermMatrix) -> DataFrame:
    """The carried columns with n_words (the row's sum) and n_distinct (its nonzeros)."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    return matrix.rows.withColumns({"n_words": total, "n_distinct": F.size("terms").cast("long")}).drop("terms", "counts")


# ---------------------------------------------------------------- the audit

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
_BITS = {f: 1 << i for i, f in enumerate(FILTERS)}


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part, failed filters (a bit each, A the lowest) and label: part, failed, good, toxic, documents.
    `docs` has doc_id, text and source, `labels` doc_id, quality and toxic."""
    text = F.coalesce(F.col("text"), F.lit(""))
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    flags = docs.select(
        "doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), (100 * upper > 5 * F.length(text)).alias("c"),
        text.rlike(r"[#$%&*|]").alias("d"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )
    rows = row_totals(build(flags))
    low = {"A": F.col("n_words") < 50, "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"), "C": F.col("c"), "D": F.col("d")}
    failed = sum((F.when(v, _BITS[f]).otherwise(0) for f, v in low.items()), F.lit(0))
    rows = rows.select("doc_id", "part", "digest", failed.alias("failed"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good, toxic = (F.coalesce(F.col(c) == 1, F.lit(False)) for c in ("quality", "toxic"))
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").select(*rows.columns, good.alias("good"), toxic.alias("toxic"))
    # copies of a text shrink to a row per part and label before those of one text meet; a text has one set of flags
    group = ["digest", "part", "failed", "good", "toxic"]
    copies = known.groupBy(*group, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy(*group).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    smallest = F.col("first.doc_id") == F.min("first.doc_id").over(Window.partitionBy("digest"))
    copies = copies.withColumn("firsts", F.when(smallest, F.col("first.n")).otherwise(0))
    both = F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.col("firsts").alias("n")), F.struct(F.lit(_BITS["E"]).alias("bit"), (F.col("n") - F.col("firsts")).alias("n"))))
    copies = copies.select(*group[1:], both.alias("e")).select("part", (F.col("failed") + F.col("e.bit")).alias("failed"), "good", "toxic", "e.n")
    unknown = rows.filter("doc_id IS NULL").select("part", "failed", F.lit(False).alias("good"), F.lit(False).alias("toxic"), F.lit(1).cast("long").alias("n"))
    return copies.unionByName(unknown).filter("n > 0").groupBy(*group[1:]).agg(F.sum("n").alias("documents"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counts = failures(docs, labels)
    steps = F.explode(F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(_BITS[f]).alias("bit"), F.lit(sum(_BITS[x] for x in o[:k])).alias("before")) for o in ORDERS for k, f in enumerate(o))))
    rows = counts.withColumn("s", steps).select("*", "s.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("failed").bitwiseAND(F.col("before")) != 0
    removed = fails & ~earlier
    # first of the filters that it fails in so many of the orders
    share = F.when(fails, F.floor(F.lit(len(ORDERS)) / F.greatest(F.bit_count("failed"), F.lit(1)))).otherwise(0)

    def number(which):
        return F.coalesce(F.sum(F.when(which, F.col("documents"))), F.lit(0))

    return rows.groupBy("part", "filter_order", "step").agg(
        number(~fails & ~earlier).alias("kept"), number(removed).alias("removed"), number(fails & earlier).alias("redundant"),
        number(F.col("failed") == F.col("bit")).alias("unique_fails"), number(removed & F.col("good")).alias("good_lost"),
        number(removed & F.col("toxic")).alias("toxic_lost"), F.sum(share * F.col("documents")).alias("shapley"),
    )
