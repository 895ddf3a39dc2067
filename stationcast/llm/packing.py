"""Packing documents into training sequences by non-negative least squares over the histogram of their lengths.

Each document is its ids and an end id. Its first floor(n / window) windows are sequences of their own; what remains is
shorter than the window, so the lengths of the remainders are a histogram of at most window - 1 numbers, whatever the
corpus. Over it:

1. shallow combinations of two to four lengths that fill the window exactly are enumerated;
2. non-negative least squares (coordinate descent from zero, so that the solution stays sparse) finds how often to
   repeat each of them to use up the histogram;
3. repeat counts are rounded down to what the histogram holds;
4. of what that leaves, every triple of lengths that fills the window is tried, those with most documents left first;
5. the rest is packed greedily, largest length first, where that fills a window exactly, and what is left after that
   is laid end to end and cut at the windows. The last, shorter stretch is cut into powers of two.

So no sequence is padded. Only documents of step 5's last part are cut within their remainder.

The plan is a few thousand lines: for each length, which ranks go to which sequences. A document's rank among the
remainders of its length is its rank in its task plus a running total over the tasks, so no task or group sees all
documents of a length. Each task's totals are a file of at most `window` lines, which the task that reads its ids opens.
Ids are written once, as a table in the shared folder, and read once; nothing but the plan is sent to the tasks.

Defined results: a null or empty text is its end id alone; rows with the same document id are packed separately; a null
id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm import tokens
from stationcast.llm.support import file_system, map_arrow, scratch, with_prefix_sums, written

WINDOW = 2048
END_ID = 1
#: Of all triples of lengths, those whose two smaller lengths sum up to a multiple of this are in the least squares; the
#: others are tried on its rest.
TRIPLE_STEP = 16
SWEEPS = 30


def combinations(lengths: list[int], window: int, step: int = TRIPLE_STEP) -> list[tuple[tuple[int, int], ...]]:
    """Sets of (length, how often) with two to four lengths in all that fill the window."""
    have, out = set(lengths), set()

    def add(*parts: int) -> None:
        if all(p in have for p in parts):
            counts: dict[int, int] = {}
            for p in parts:
                counts[p] = counts.get(p, 0) + 1
            out.add(tuple(sorted(counts.items())))

    for a in lengths:
        add(a, window - a)
        add(a, a, window - 2 * a)
        add(a, a, a, window - 3 * a)
        if 2 * a < window and window % 2 == 0:
            add(a, a, window // 2 - a, window // 2 - a)
    ordered = sorted(lengths)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if a + 2 * b > window:
                break
            if (a + b) % step == 0:
                add(a, b, window - a - b)
    return sorted(out)


def least_squares(combos: list[tuple[tuple[int, int], ...]], histogram: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Repeat counts x >= 0 that minimise the squared difference between the combinations' lengths and the histogram."""
    left = {k: float(v) for k, v in histogram.items()}
    x = [0.0] * len(combos)
    norms = [float(sum(m * m for _, m in c)) for c in combos]
    for _ in range(sweeps):
        moved = 0.0
        for i, combo in enumerate(combos):
            step = sum(m * left[k] for k, m in combo) / norms[i]
            if step < -x[i]:
                step = -x[i]
            if step > 1e-9 or step < -1e-9:
                x[i] += step
                moved += abs(step)
                for k, m in combo:
                    left[k] -= m * step
        if moved < 1e-3 * (1 + sum(x)):
            break
    return x


def triple_fill(left: dict[int, int], window: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Triples of different lengths that fill a window, most documents left first, with how often; takes them out of
    `left`, so that no such triple can be formed afterwards."""
    count = np.zeros(window + 1, np.int64)
    for k, v in left.items():
        count[k] = v
    have = np.flatnonzero(count).astype(np.int32)
    last = window - have[:, None] - have[None, :]
    i, j = np.nonzero((have[None, :] > have[:, None]) & (last > have[None, :]))
    a, b, c = have[i], have[j], last[i, j]
    full = count[c] > 0
    a, b, c = a[full], b[full], c[full]
    by_gain = np.argsort(-(count[a] + count[b] + count[c]), kind="stable")
    out = []
    for x, y, z in zip(a[by_gain].tolist(), b[by_gain].tolist(), c[by_gain].tolist()):
        times = min(left[x], left[y], left[z])
        if times:
            for k in (x, y, z):
                left[k] -= times
            out.append((((x, 1), (y, 1), (z, 1)), times))
    return out


def greedy_fill(left: dict[int, int], window: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Combinations that fill a window exactly, largest length first, with how often; takes them out of `left`."""
    out, open_ = [], sorted((k for k, v in left.items() if v), reverse=True)
    for top in open_:
        while left[top]:
            gap, used = window, {}
            for k in (k for k in open_ if k <= top):
                n = min(gap // k, left[k])
                if n:
                    used[k], gap = n, gap - n * k
                if not gap:
                    break
            if gap:
                break
            times = min(left[k] // n for k, n in used.items())
            for k, n in used.items():
                left[k] -= n * times
            out.append((tuple(sorted(used.items())), times))
    return out


@dataclass(frozen=True)
class Plan:
    """Where the r-th remainder of each length goes. Lines are sorted by key = length << 44 | first rank."""

    window: int
    keys: np.ndarray
    lines: np.ndarray  # copies in a sequence (0: end to end), first sequence, offset of the first copy, place
    cuts: np.ndarray  # places where the stretch laid end to end is cut
    cut_sequence: int

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the pieces of one remainder."""
        i = int(np.searchsorted(self.keys, (length << 44) | rank, "right")) - 1
        copies, sequence, offset, at = (int(v) for v in self.lines[i])
        r = rank - (int(self.keys[i]) & ((1 << 44) - 1))
        if copies:
            return [(sequence + r // copies, offset + r % copies * length, length)]
        at, end, out = at + r * length, at + (r + 1) * length, []
        while at < end:
            k = int(np.searchsorted(self.cuts, at, "right")) - 1
            stop = min(end, int(self.cuts[k + 1]))
            out.append((self.cut_sequence + k, at - int(self.cuts[k]), stop - at))
            at = stop
        return out


def make_plan(histogram: dict[int, int], full: int, window: int = WINDOW) -> Plan:
    """histogram: of remainders; full: number of whole windows, which are sequences 0 to full - 1."""
    left = {k: v for k, v in histogram.items() if k and v}
    combos = combinations(list(left), window)
    repeats = least_squares(combos, left)
    packed = []
    for i in sorted(range(len(combos)), key=lambda i: -repeats[i]):
        times = min([int(repeats[i] + 1e-6), *(left[k] // m for k, m in combos[i])])
        if times > 0:
            packed.append((combos[i], times))
            for k, m in combos[i]:
                left[k] -= m * times
    packed += triple_fill(left, window)
    packed += greedy_fill(left, window)
    lines, ranks, sequence = [], dict.fromkeys(histogram, 0), full
    for combo, times in packed:
        offset = 0
        for k, m in combo:
            lines.append(((k << 44) | ranks[k], m, sequence, offset, 0))
            ranks[k] += m * times
            offset += m * k
        sequence += times
    at = 0
    for k, n in sorted(left.items(), reverse=True):
        if n:
            lines.append(((k << 44) | ranks[k], 0, 0, 0, at))
            at += k * n
    whole = at // window
    ends = []
    rest, place = at - whole * window, whole * window
    for bit in range(window.bit_length(), -1, -1):
        if rest >> bit & 1:
            place += 1 << bit
            ends.append(place)
    cuts = np.concatenate([np.arange(whole + 1, dtype=np.int64) * window, np.array(ends, np.int64)])
    lines.sort()
    table = np.array([x[1:] for x in lines], np.int64).reshape(-1, 4)
    return Plan(window, np.array([x[0] for x in lines], np.int64), table, cuts, sequence)


def _encoder(path: str, window: int, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, windows = TaskContext.get().partitionId(), {}, 0
        enc = tokens.encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids = [x + end for x in tokens.encoded(batch.column(1).to_pylist(), path)]
            counts = [len(x) // enc.width for x in ids]
            ranks, firsts = [], []
            for n in counts:
                short = n % window
                ranks.append(seen.get(short, 0))
                seen[short] = ranks[-1] + 1
                firsts.append(windows)
                windows += n // window
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(counts, pa.int64()), pa.array([n % window for n in counts], pa.int64()),
                 pa.array(ranks, pa.int64()), pa.array(firsts, pa.int64()), pa.array([enc.width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["doc_id", "part", "doc_tokens", "short", "rank", "windows", "width", "ids"],
            )

    return encode


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids (binary)."""
    path = os.path.abspath(tokenizer or tokens.default_path())
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = written(map_arrow(
        rows, _encoder(path, window, end_id),
        f"doc_id {kind}, part long, doc_tokens long, short long, rank long, windows long, width int, ids binary",
    ), "packing-ids")
    whole = F.floor(F.col("doc_tokens") / window).cast("long")
    counts = written(rows.groupBy("part", "short").agg(F.count(F.lit(1)).alias("n"), F.sum(whole).alias("windows")), "packing-counts")
    histogram = {r.short: r.n for r in counts.groupBy("short").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    full = counts.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    plan = make_plan(histogram, full, window)
    # what the tasks before hold of this length, and of whole windows: a file for each task's rows, read by whoever reads those
    before = Window.partitionBy("short").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = with_prefix_sums(counts.groupBy("part").agg(F.sum("windows").alias("w")), "part", {"window_base": "w"})
    bases = counts.withColumn("rank_base", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts.select("part", "window_base"), "part")
    folder = scratch(docs.sparkSession, "packing-bases")
    bases.select("part", "short", "rank_base", "window_base").repartition("part").write.partitionBy("part").parquet(folder)

    def bases_of(part: int) -> tuple[list[int], int]:
        from pyarrow import dataset

        fs, path = file_system(f"{folder}/part={part}")
        table = dataset.dataset(path, filesystem=fs, format="parquet").to_table().to_pydict()
        ranks = [0] * window
        for short, base in zip(table["short"], table["rank_base"]):
            ranks[short] = base
        return ranks, table["window_base"][0]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            at, out = [], [[] for _ in range(7)]
            for r, (part, n, short, rank, first, width, ids) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                if part != last:
                    (ranks, windows), last = bases_of(part), part
                ids, start = np.frombuffer(ids, f"u{width}"), 0
                spots = [(windows + first + w, 0, window) for w in range(n // window)] + (plan.place(short, rank + ranks[short]) if short else [])
                for sequence, offset, length in spots:
                    piece = ids[start : start + length]
                    at.append(r)
                    for column, value in zip(out, (start, length, tokens.crc_of_ids(piece), n, sequence, offset, piece.astype("<u4").tobytes() if with_ids else None)):
                        column.append(value)
                    start += length
            columns = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in out[:6])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out[6], pa.binary())][: 8 if with_ids else 7], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_arrow(rows, pieces, schema + ", ids binary" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length and ids (little-endian unsigned 32-bit, binary) of packed pieces that carry their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))  # at most `window` pieces each
    joined = pieces.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("length"))
    return joined.select("sequence_id", "length", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
