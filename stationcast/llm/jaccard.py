"""Documents whose word shingles reach a Jaccard similarity, by a grouped prefix join.

1. A document's set is its distinct k-word shingles, as 64-bit hashes. Equal sets are one class.
2. Shingles are ordered rarest first, by the counts of a fixed-size sketch over all documents, then by hash. Two similar
   sets share `SHARED` shingles (or all that sets so small can share) within their prefixes. Classes with equal prefix and size are one group, so the join
   below works on groups.
3. Groups that share enough shingles of their prefixes, sizes allowing, are candidates. Where few groups share a
   shingle, their pairs are counted; where many do, all of them are tied to the smallest, without pairs.
4. The candidates' connected components are families: no link leaves one. A family is expanded to its classes, dealt
   into blocks of bounded size, and each pair of blocks is verified exactly in one task that holds the two. In a family of
   many blocks these are of like sizes, and pairs of blocks whose sizes rule out a link are left out. Such blocks are files
   that their tasks read, so a set is shuffled and stored once, however many blocks its own meets.
5. A task returns, for each class with a link, the class it hangs together with and the number of its links, never pairs.

So each text counts once however many copies it has, hot shingles and hot families cost no more rows than members, and
no link between two different texts is lost.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with nothing; a text of
fewer than k words is one shingle; rows with equal document id are separate documents that share the id; the
component of documents that have no id at all is null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.components import components
from stationcast.llm.support import WORD, file_system, map_arrow, open_file, per_process, scratch, session, written

SHINGLE_WORDS = 3
PERCENT = 90
#: Shingles that two similar sets must share within their prefixes.
SHARED = 3
#: Counters of the frequency sketch, the least and the most of them, and the shingles to a counter up to which they are doubled.
SKETCH_BITS, MOST_SKETCH_BITS = 20, 24
COUNTER_SHINGLES = 32
SKETCH_CHUNK = 1 << 12
#: Bytes of a word with its blank.
WORD_BYTES = 7
#: Groups that may share a shingle before they are tied together instead of paired.
PAIRED = 32
#: Classes, and shingles, of a block of a family.
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 20
#: Bits of the bitmap that tells which documents are fetched for verification.
FETCH_BITS = 1 << 23

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 250_000:
            self.clear()
        self[word] = value
        return value


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text. Lower-casing and splitting bytes touches ASCII alone."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = per_process("word-hashes", _WordHashes)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    x = h[: len(h) - width + 1] + np.uint64(width)
    for j in range(1, width):
        x = (x ^ (x >> np.uint64(29))) * _M1 + h[j : len(h) - width + 1 + j]
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return np.unique(x ^ (x >> np.uint64(31)))


def least_overlap(n, percent: int):
    """Shingles that a set of n must share with any similar set."""
    return -(-percent * n // 100)


def smallest_linked(percent: int) -> int:
    """The size from which a set can be similar to a different one: n / (n + 1) reaches the percentage."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def sketch_bits(docs: DataFrame) -> int:
    """The size of the sketch follows the text: with too many shingles to a counter all counters read alike, rare shingles
    cannot be told from common ones, and prefixes of common ones tie unlike documents to one family."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(SKETCH_BITS, math.ceil(math.log2(max(size / WORD_BYTES / COUNTER_SHINGLES, 1)))), MOST_SKETCH_BITS)


def frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """Counts of all shingles of all documents (each once a document) in 2 ** sketch_bits counters, up to 65535. Tasks add up
    their own documents; chunks of counters are added up as they stream past. What the driver gets has a bounded size."""
    bits, most = sketch_bits(docs), np.iinfo(np.uint16).max
    shift, chunk_size = np.uint64(64 - bits), SKETCH_CHUNK

    def packed(chunks, counters) -> pa.RecordBatch:
        data = [zlib.compress(np.minimum(x, most).astype(np.uint16).tobytes(), 1) for x in counters]
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(data, pa.binary())], ["chunk", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, waiting, size = np.zeros(1 << bits, np.uint32), [], 0

        def flush():
            places, times = np.unique(np.concatenate(waiting), return_counts=True)
            counters[places] += times.astype(np.uint32)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append((shingles(text, k) >> shift).astype(np.int32))
                size += len(waiting[-1])
                if size > 1 << 20:
                    flush()
                    waiting, size = [], 0
        if waiting:
            flush()
        chunks = counters.reshape(-1, chunk_size)
        used = np.flatnonzero(chunks.any(axis=1))
        yield packed(used, (chunks[i] for i in used))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(counts), np.uint16).astype(np.uint32)
                sums[chunk] = sums[chunk] + counts if chunk in sums else counts
        yield packed(list(sums), sums.values())

    schema = "chunk long, counts binary"
    total = np.zeros((1 << bits) // chunk_size * chunk_size, np.uint16).reshape(-1, chunk_size)
    for row in map_arrow(map_arrow(docs.select("text"), count, schema).repartition("chunk"), add, schema).collect():
        total[row.chunk] = np.frombuffer(zlib.decompress(row.counts), np.uint16)
    return total.reshape(-1)


def prefixes(docs: DataFrame, counts: np.ndarray, k: int, percent: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `carry`, n, digest (of the set), group (digest of prefix and size), prefix for each document."""
    shared = session(docs).sparkContext.broadcast(counts)  # of bounded size
    shift, least = np.uint64(65 - len(counts).bit_length()), smallest_linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            sizes, digests, groups, heads = [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                x = shingles(text, k)
                n = len(x)
                sizes.append(n)
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                if n < least:
                    groups.append(None)
                    heads.append(None)
                    continue
                length = min(n, n - least_overlap(n, percent) + SHARED)
                head = x[np.lexsort((x, common[(x >> shift).astype(np.int64)]))[:length]]
                groups.append(hashlib.blake2b(head.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest())
                heads.append(head.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(groups, pa.binary()), pa.array(heads, pa.list_(pa.int64()))],
                [*kept, "n", "digest", "group", "prefix"],
            )

    kept = ["doc_id", *carry]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    return map_arrow(docs.select(*kept, "text"), run, f"{kinds}, n long, digest binary, group binary, prefix array<long>")


def families(groups: DataFrame, percent: int) -> DataFrame:
    """gid, family for the groups (gid, n, prefix) that have a candidate."""
    entries = groups.select("gid", "n", F.explode("prefix").alias("token"))
    tokens = entries.groupBy("token").agg(F.count(F.lit(1)).alias("sharing"), F.min("gid").alias("leader")).filter("sharing > 1")
    entries = written(entries.join(tokens, "token"), "jaccard-shared")
    few = entries.filter(F.col("sharing") <= PAIRED).select("token", "gid", "n")
    other = few.select("token", F.col("gid").alias("gid2"), F.col("n").alias("n2"))
    fits = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (F.col("gid") < F.col("gid2"))
    larger = F.greatest("n", "n2")
    enough = F.least(F.lit(SHARED), F.ceil(larger * percent / 100))  # sets so small that they cannot share more
    pairs = few.join(other, "token").filter(fits).groupBy("gid", "gid2").agg(F.count(F.lit(1)).alias("c"), F.max(enough).alias("enough")).filter("c >= enough")
    stars = entries.filter((F.col("sharing") > PAIRED) & (F.col("gid") > F.col("leader"))).select("gid", "leader").distinct()
    edges = pairs.select(F.col("gid").alias("u"), F.col("gid2").alias("v")).unionByName(stars.select(F.col("gid").alias("u"), F.col("leader").alias("v")))
    return components(edges).select(F.col("node").alias("gid"), F.col("label").alias("family"))


def linked(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Boolean matrix of similar pairs between two lists of sets, or within the first. Shingles that only one of the sets
    has are left out; the others are columns of matrices whose product counts common shingles."""
    every = sets_a + (sets_b or [])
    na, sizes = len(sets_a), np.array([len(x) for x in every], np.int64)
    overlap = np.zeros((na, len(every) - na if sets_b is not None else na), np.float64)
    tokens, column, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    common = counts > 1
    place = np.cumsum(common) - 1
    owner = np.repeat(np.arange(len(every)), sizes)
    keep = common[column]
    column, owner = place[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = max(256, (1 << 23) // max(len(every), 1))
    for start in range(0, int(common.sum()), step):
        lo, hi = np.searchsorted(column, [start, start + step])
        block = np.zeros((len(every), min(step, int(common.sum()) - start)), np.float32)
        block[owner[lo:hi], column[lo:hi] - start] = 1
        overlap += block[:na] @ (block[na:] if sets_b is not None else block).T
    right = sizes[na:] if sets_b is not None else sizes
    union = sizes[:na, None] + right[None, :] - overlap
    out = 100 * overlap >= percent * union
    if sets_b is None:
        np.fill_diagonal(out, False)
    return out


def roots(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the first row of its connected component."""
    out = np.full(len(links), -1, np.int64)
    for i in range(len(links)):
        if out[i] >= 0:
            continue
        out[i], front = i, np.array([i])
        while len(front):
            near = np.flatnonzero(links[front].any(axis=0) & (out < 0))
            out[near], front = i, near
    return out


def _solve(first: list[tuple], second: list[tuple] | None, percent: int) -> pa.RecordBatch:
    """cid, root (cid), links of the classes (cid, copies, set) of one block, or of two that meet, that have a link there."""
    links = linked([r[2] for r in first], None if second is None else [r[2] for r in second], percent)
    if second is not None:
        whole = np.zeros((len(first) + len(second),) * 2, bool)
        whole[: len(first), len(first) :] = links
        links = whole | whole.T
    every = first + (second or [])
    cids, copies = (np.array([r[i] for r in every], np.int64) for i in (0, 1))
    some = links.any(axis=1)
    found = cids[some], cids[roots(links)][some], (links @ copies)[some]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["cid", "root", "links"])


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(family, block), others, classes of each block, from rows sorted by (family, block)."""
    key, meets, rows = None, None, []
    for batch in batches:
        for family, block, others, cid, copies, data in zip(*(c.to_pylist() for c in batch.columns)):
            if (family, block) != key:
                if rows:
                    yield key, meets, rows
                key, meets, rows = (family, block), others, []
            rows.append((cid, copies, np.frombuffer(data, np.uint64)))
    if rows:
        yield key, meets, rows


def verified(rows: DataFrame, percent: int) -> DataFrame:
    """cid, root, links for the classes (family, block, others, cid, copies, set). Blocks that meet themselves alone are
    verified where their rows are dealt to. All others become files, each with its own classes, and a task for some pairs of
    blocks reads what it is to compare: rows and disk do not grow with the pairs."""
    spark, found = session(rows), "cid long, root long, links long"
    rows = rows.select("family", "block", "others", "cid", "copies", "set")
    dealt = lambda df: df.repartition("family", "block").sortWithinPartitions("family", "block")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, classes in _each_block(batches):
            yield _solve(classes, None, percent)

    single = map_arrow(dealt(rows.where(F.size("others") == 1)), alone, found)
    folder = scratch(spark, "jaccard-blocks")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (family, block), others, classes in _each_block(batches):
            file = f"{uuid.uuid4().hex}.arrow"  # of this attempt alone; only files of finished tasks are named
            table = pa.table([pa.array([r[0] for r in classes], pa.int64()), pa.array([r[1] for r in classes], pa.int64()), pa.array([r[2].tobytes() for r in classes], pa.large_binary())], ["cid", "copies", "set"])
            fs, path = file_system(folder)
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{file}", compression=None) as out, pa.ipc.new_file(out, table.schema) as writer:
                writer.write_table(table)
            yield pa.RecordBatch.from_arrays([pa.array([family], pa.int64()), pa.array([block], pa.int64()), pa.array([others], pa.list_(pa.int64())), pa.array([file])], ["family", "block", "others", "file"])

    blocks = map_arrow(dealt(rows.where(F.size("others") > 1)), keep, "family long, block long, others array<long>, file string")
    blocks = written(blocks, "jaccard-block-files")
    pairs = blocks.select("family", "file", "block", F.explode("others").alias("other")).where("other >= block")
    pairs = pairs.join(blocks.select("family", F.col("block").alias("other"), F.col("file").alias("file2")), ["family", "other"]).select("file", "file2")
    pairs = written(pairs, "jaccard-pairs")
    count, tasks = pairs.count(), 4 * spark.sparkContext.defaultParallelism
    if not count:
        return single

    def classes_of(file: str) -> list[tuple]:
        with open_file(f"{folder}/{file}") as source:
            table = pa.ipc.open_file(source).read_all()
        return [(cid, copies, np.frombuffer(data, np.uint64)) for cid, copies, data in zip(*(c.to_pylist() for c in table.columns))]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first = None, []
        for batch in batches:
            for file, file2 in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    name, first = file, classes_of(file)
                yield _solve(first, None if file2 == file else classes_of(file2), percent)

    pairs = pairs.repartition(min(count, max(tasks, count // 64))).sortWithinPartitions("file")
    return single.unionByName(map_arrow(pairs, meet, found))


def _blocks(members: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(members) / BLOCK_CLASSES), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("long")


def blocked(classes: DataFrame, percent: int) -> DataFrame:
    """The classes of families of two or more, each with its block and the blocks that it is to meet.

    A family of more than one block is cut by set size first: two sets can only be similar if the larger is at most
    100 / percent times the smaller, so with classes of sizes that grow by this factor, a block meets those of its own
    class and of the two beside it. Within a class of sizes blocks are dealt by hash."""
    count = (F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    whole = classes.groupBy("family").agg(*count).filter("m > 1").select("family", _blocks("m", "s").alias("whole"))
    # a little more than the factor, so that rounding never puts two similar sets two classes apart
    size = F.col("n") if percent >= 100 else F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * 1.000001))
    rows = classes.join(whole, "family").withColumn("sizes", F.when(F.col("whole") == 1, 0).otherwise(size).cast("long")).drop("whole")
    parts = rows.groupBy("family", "sizes").agg(*count).select("family", "sizes", _blocks("m", "s").alias("blocks"))
    # a few hundred classes of sizes at most, whatever the family
    rows = rows.join(parts.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("sizes", "blocks"))).alias("by")), "family")
    name = lambda sizes, block: F.shiftleft(sizes, 32).bitwiseOR(block)
    near = F.filter(F.array(F.col("sizes") - 1, F.col("sizes"), F.col("sizes") + 1), lambda c: F.map_contains_key("by", c))
    others = F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0).cast("long"), F.element_at("by", c) - 1), lambda b: name(c, b))))
    own = name(F.col("sizes"), F.pmod(F.xxhash64("cid"), F.element_at("by", F.col("sizes"))))
    return rows.withColumns({"block": own, "others": others}).drop("by", "sizes")


def similarity_join(docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `carry`, n_shingles, component_id (smallest document id reachable by links), n_links (similar documents,
    copies included), component (a number for each component, null without words)."""
    k = shingle_words
    heads = written(prefixes(docs, frequencies(docs, k), k, percent, carry), "jaccard-prefixes")
    groups = heads.filter(F.col("group").isNotNull()).groupBy("group").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = written(groups.withColumn("gid", F.monotonically_increasing_id()), "jaccard-groups")
    classes = heads.filter("n > 0").groupBy("digest", "n").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("group").alias("group")
    )
    classes = classes.join(groups.select("group", "gid"), "group", "left")
    classes = classes.join(families(groups, percent), "gid", "left")
    classes = classes.withColumn("family", F.coalesce("family", "gid")).withColumn("cid", F.monotonically_increasing_id())
    classes = written(classes.drop("group", "gid"), "jaccard-classes")

    members = written(blocked(classes.filter("family IS NOT NULL"), percent), "jaccard-members")
    sets = written(_sets_of(docs, members, k), "jaccard-sets")
    found = written(verified(sets, percent), "jaccard-links")
    labels = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    classes = classes.join(labels, classes["cid"] == labels["node"], "left").withColumn("label", F.coalesce("label", "cid")).drop("node", "family")
    smallest = classes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = classes.join(smallest, "label").join(links, "cid", "left").select(
        "digest", "component_id", F.col("label").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = heads.select("doc_id", *carry, "n", "digest").join(classes, "digest", "left")
    return out.select(
        "doc_id", *carry, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "component",
    )


def _sets_of(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The members with their set (hashes, binary). Texts are not shuffled: a bitmap of fixed size over hashes of the classes'
    document ids says which documents are worth a look, the digest whether it is the one."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FETCH_BITS)) + 1
    bits = members.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
    wanted = np.zeros(FETCH_BITS // 8, np.uint8)
    for row in bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect():  # FETCH_BITS bits in all
        at = (row.bucket - 1) * len(row.bits)
        wanted[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    look = session(docs).sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False) - 1
            near = np.flatnonzero(look.value[p >> 3] >> (p & 7).astype(np.uint8) & 1)
            found = [shingles(t, k) for t in batch.column(1).take(pa.array(near, pa.int64())).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())],
                ["digest", "set"],
            )

    rows = map_arrow(docs.select(place.alias("p"), "text"), run, "digest binary, set binary")
    sets = rows.join(members.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first("set").alias("set"))
    return members.join(sets, "digest")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, that with the smallest id, with the columns of `docs`; documents without words
    all stay."""
    key = ["__k1", "__k2"]  # 96 bits of id and text
    rows = docs.withColumns({"__k1": F.xxhash64("doc_id", "text"), "__k2": F.hash("text", "doc_id")})
    found = similarity_join(rows, carry=tuple(key), **settings)
    chosen = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", *key)).alias("s"))
    chosen = written(chosen.select("s.__k1", "s.__k2"), "jaccard-chosen")
    first = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    kept = rows.join(chosen, key).withColumn("__nth", first).filter("__nth = 1").select(*docs.columns)
    return kept.unionByName(docs.filter(~F.coalesce(F.col("text").rlike(WORD), F.lit(False))))
