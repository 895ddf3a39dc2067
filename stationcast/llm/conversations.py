"""Cheapest repair of a conversation's structure, by Four-Russians block tables.

A conversation is a sequence of rows (turn, role, text), ordered by turn (nulls first), then role, then text. A row's first
fault counts: blank (no character but white space), duplicate (role and text seen earlier), truncated (the last character
that is not white space is none of `.!?`). Edits and their costs: Keep 0, Rerole to user or assistant 1, Delete 2 (a must
for blank and duplicate rows), Insert an empty user or assistant row 5; a truncated row that stays adds 5. The result's
role initials match `(s?(ua)+)?`; among the cheapest edits those whose initials (D, I, K, R) come first in ASCII are taken.

Method. A row matters only by its symbol (one of nine: must go, or initial s/u/a/other, truncated or not). The costs of
finishing the rest of a conversation from each of four states differ by a bounded amount, so that less their minimum only a
few dozen cost vectors exist. A table holds, for each vector and each block of `BLOCK` symbols, the vector before the block
and what the minimum has grown by. The sweep runs over whole blocks from the last row to the first, by lookup. Then each
block is expanded from the vector behind it, in the rows' order, so that at every row the costs of all ways to go on are
known and the least letter among the cheapest can be taken.

On Spark. Rows are dealt by range of (conversation, turn, role, start of the text) and sorted, so that a conversation of any
size is spread over as many tasks as it fills. A task repairs the conversations that lie whole inside it, one at a time. Those at its two ends
and those of more than `HELD_ROWS` rows or `HELD_CHARS` characters go on as rows: their duplicates are found by grouping,
their symbols are gathered, one byte a row (as long as the audit that is to be returned), and their repaired rows
pass in order through one task that only hashes them, since SHA-256 has no other way; nothing of them is held in memory.

Results for odd rows: null roles and texts count as one space; null conversations are one conversation of their own; null
turns come first and do not count as gaps. Of rows that agree in everything, the first is no duplicate. A conversation whose
rows all go has an empty audit and the hash of an empty string. No rows give no conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow, per_process, written

BLOCK = 4
HELD_ROWS, HELD_CHARS = 4096, 4 << 20
CHUNK = 4096
BLANKS = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Nothing yet, after system, after user, after assistant; a conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = 4
_CLASSES = "suao"
#: Symbol 0 must go; the others are 1 + 2 * class + truncated.
SYMBOLS = 1 + 2 * len(_CLASSES)
_TURN_OF = (USER, USER, ASSISTANT, USER)
_LEGAL = {"su", "ua", "au"}


def _end_costs() -> tuple[int, ...]:
    return (0, 2 * INSERT, INSERT, 0)


def _ways(state: int, symbol: int, after: tuple[int, ...]) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and next state of each way to deal with a row of this symbol, in the letters' order."""
    yield DELETE + after[state], "D", state
    if symbol:
        kind, extra = _CLASSES[(symbol - 1) // 2], CUT * ((symbol - 1) % 2)
        to = _TURN_OF[state]
        if state == START and kind == "s":
            yield KEEP + extra + after[SYSTEM], "K", SYSTEM
        elif kind == ("a" if to == ASSISTANT else "u"):
            yield KEEP + extra + after[to], "K", to
        yield REROLE + extra + after[to], "R", to


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of finishing before a row, from those behind it; a row may be inserted first, or two."""
    costs = [min(w[0] for w in _ways(q, symbol, after)) for q in range(_STATES)]
    for _ in range(2):
        costs = [min(c, INSERT + costs[_TURN_OF[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _letters(state: int, symbol: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The edits up to and with this row, least letters first, and the state behind it."""
    costs, out = _before(symbol, after), ""
    while True:
        ways = [(letter, to) for cost, letter, to in _ways(state, symbol, after) if cost == costs[state]]
        if INSERT + costs[_TURN_OF[state]] == costs[state]:
            ways.append(("I", _TURN_OF[state]))
        letter, state = min(ways)
        out += letter
        if letter != "I":
            return out, state


class BlockTables:
    """Vectors less their minimum, by number, and their transitions over one symbol and over blocks."""

    def __init__(self, block: int = BLOCK):
        first, base = self._normal(_end_costs())
        self.vectors, number, self.last = [first], {first: 0}, base
        step, grow = [], []
        for v in self.vectors:  # grows as new vectors are met
            row = [self._normal(_before(s, v)) for s in range(SYMBOLS)]
            for normal, _ in row:
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
            step.append([number[n] for n, _ in row])
            grow.append([g for _, g in row])
        self.block, self.step, self.grow = block, step, grow
        one, plus = np.array(step), np.array(grow)
        over, sums = np.arange(len(step))[:, None], np.zeros((len(step), 1), int)
        for _ in range(block):  # a symbol more in front
            over, sums = one[over].transpose(0, 2, 1).reshape(len(step), -1), (sums[:, :, None] + plus[over]).transpose(0, 2, 1).reshape(len(step), -1)
        self.over, self.sums = over.tolist(), sums.tolist()
        self.letters = [[[_letters(q, s, v) for q in range(_STATES)] for s in range(SYMBOLS)] for v in self.vectors]
        self.expanded: dict = {}

    @staticmethod
    def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        least = min(costs)
        return tuple(c - least for c in costs), least

    def _expand(self, v: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Edits of a block's rows from the vector behind it and the state before it."""
        found = self.expanded.get((v, symbols, state))
        if found is None:
            behind = [v]
            for s in symbols[:0:-1]:
                behind.append(self.step[behind[-1]][s])
            out, q = "", state
            for s, w in zip(symbols, reversed(behind)):
                letters, q = self.letters[w][s][q]
                out += letters
            found = self.expanded[v, symbols, state] = out, q
        return found

    def solve(self, symbols: bytes) -> tuple[int, str]:
        """Cost and letters of the cheapest edits."""
        rest = len(symbols) % self.block
        whole = len(symbols) - rest
        rows = np.frombuffer(symbols, np.uint8)[:whole].reshape(-1, self.block).astype(np.int64)
        codes = (rows @ (SYMBOLS ** np.arange(self.block)[::-1])).tolist()
        v, cost = 0, self.last
        for s in symbols[:whole - 1 if whole else None:-1] if rest else b"":
            cost += self.grow[v][s]
            v = self.step[v][s]
        behind = [v]
        for code in reversed(codes):
            cost += self.sums[v][code]
            v = self.over[v][code]
            behind.append(v)
        cost += self.vectors[v][START]
        parts, state = [], START
        for k, w in enumerate(reversed(behind[:-1])):
            letters, state = self._expand(w, symbols[k * self.block : (k + 1) * self.block], state)
            parts.append(letters)
        if rest:
            letters, state = self._expand(0, symbols[whole:], state)
            parts.append(letters)
        parts.append("I" * (_end_costs()[state] // INSERT))
        return cost, "".join(parts)


def tables() -> BlockTables:
    return per_process("conversation-blocks", BlockTables)


class Editor:
    """Applies the letters of an audit to the rows, one after another."""

    def __init__(self, audit: str):
        self.letters, self.state = iter(audit), START

    def _add(self, letter: str, role: str, text: str) -> tuple[str, str, str]:
        self.state = SYSTEM if letter == "K" and self.state == START and role[:1] == "s" else _TURN_OF[self.state]
        return letter, role if letter == "K" else "user" if self.state == USER else "assistant", text

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        for letter in self.letters:
            if letter != "I":
                self.letters = itertools.chain([letter], self.letters)
                return
            yield self._add("I", "", "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what this row becomes, with what is inserted before it."""
        yield from self._inserted()
        letter = next(self.letters)
        if letter != "D":
            yield self._add(letter, role, text)

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


class Tally:
    """What a conversation's rows add up to; rows come in order."""

    def __init__(self):
        self.symbols, self.blank, self.duplicate, self.truncated, self.illegal = bytearray(), 0, 0, 0, 0
        self.last = self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, kind: str, turn, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated and not (blank or duplicate)
        self.symbols.append(0 if blank or duplicate else 1 + 2 * _CLASSES.index(kind) + truncated)
        self.illegal += self.last is not None and self.last + kind not in _LEGAL
        self.last = kind
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.high = self.turn = turn

    def summary(self) -> dict:
        cost, audit = tables().solve(bytes(self.symbols))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit}


class Digest:
    """SHA-256 of the rows as `role:text`, joined by line ends."""

    def __init__(self):
        self.hash, self.place = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> int:
        self.hash.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.place - 1


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TYPES = {n: pa.int64() for n in _NUMBERS} | {"audit": pa.string(), "repaired_sha256": pa.string()}
_EDGE = {"part": pa.int64(), "pos": pa.int64(), "turn": pa.int64(), "kind": pa.string(), "is_blank": pa.bool_(), "is_truncated": pa.bool_()}
_ROW = {"place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
_ALL = {"what": pa.string()} | _TYPES | _EDGE | _ROW
_NAMES = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
_DDL = ", ".join(f"{n} {_NAMES[t]}" for n, t in _ALL.items())


class _Output:
    """Record batches of the union of summaries, rows that go on, and repaired rows."""

    def __init__(self, kind: pa.DataType):
        self.schema, self.rows, self.size = pa.schema({"conv": kind} | _ALL), [], 0

    def add(self, conv, what: str, **values) -> None:
        self.rows.append({"conv": conv, "what": what} | values)
        self.size += 64 + len(values.get("text") or "") + len(values.get("audit") or "")

    def batches(self, least: int = 1 << 20) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
            self.rows, self.size = [], 0


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _key_type(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    first = next(batches, None)
    return (None, iter(())) if first is None else (first.schema.field(0).type, itertools.chain([first], batches))


def _repair_rows(out: _Output, conv, summary: dict, rows, with_turns: bool) -> Iterator[pa.RecordBatch]:
    """The repaired rows of a conversation, if asked for, and its summary."""
    editor, digest = Editor(summary["audit"]), Digest()
    for made in itertools.chain((editor.row(role, text) for role, text in rows), [editor.rest()]):
        for letter, role, text in made:
            place = digest.add(role, text)
            if with_turns:
                out.add(conv, "row", place=place, edit=letter, role=role, text=text)
                yield from out.batches()
    out.add(conv, "summary", **summary, repaired_sha256=digest.hash.hexdigest())
    yield from out.batches()


def _inside(with_turns: bool):
    """Repairs what lies whole inside a sorted partition; passes the rows of the others on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kind, batches = _key_type(batches)
        if kind is None:
            return
        part, out, pos = TaskContext.get().partitionId(), _Output(kind), 0
        held: list[tuple] = []

        def pass_on(rows):
            nonlocal pos
            for conv, turn, role, text, c, blank, truncated in rows:
                out.add(conv, "edge", part=part, pos=pos, turn=turn, kind=c, is_blank=blank, is_truncated=truncated, role=role, text=text)
                pos += 1
                yield from out.batches()

        started, edge, chars = False, True, 0  # the first conversation may have begun in another partition
        for row in _stream(batches):
            if started and row[0] != here:
                if edge:
                    yield from pass_on(held)
                else:
                    seen, tally = set(), Tally()
                    for _, turn, role, text, c, blank, truncated in held:
                        tally.add(c, turn, blank, (role, text) in seen, truncated)
                        seen.add((role, text))
                    yield from _repair_rows(out, here, tally.summary(), (r[2:4] for r in held), with_turns)
                held, edge, chars = [], False, 0
            started, here = True, row[0]
            held.append(row)
            chars += len(row[3])
            if edge or len(held) > HELD_ROWS or chars > HELD_CHARS:
                edge = True
                yield from pass_on(held)
                held = []
        yield from pass_on(held)  # the last may go on in another
        yield from out.batches(0)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of symbols, in order, to one summary a conversation."""
    kind, batches = _key_type(batches)
    if kind is None:
        return
    out = _Output(kind)
    for conv, rows in itertools.groupby(((r[0], r[-1]) for r in _stream(batches)), key=lambda r: r[0]):
        tally = Tally()
        for _, chunk in rows:
            for r in chunk:
                tally.add(r["kind"], r["turn"], r["is_blank"], r["duplicate"], r["is_truncated"])
        out.add(conv, "audit", **tally.summary())
        yield from out.batches()
    yield from out.batches(0)


def _hashed(with_turns: bool):
    """A conversation's summary, then its rows in order, to its repaired rows and its summary with their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, batches = _key_type(batches)
        if kind is None:
            return
        out, names = _Output(kind), ["conv", "part", "pos", "role", "text", *_NUMBERS, "audit"]
        for conv, rows in itertools.groupby((dict(zip(names, r)) for r in _stream(batches)), key=lambda r: r["conv"]):
            head = next(rows)
            yield from _repair_rows(out, conv, {n: head[n] for n in (*_NUMBERS, "audit")}, ((r["role"], r["text"]) for r in rows), with_turns)
        yield from out.batches(0)

    return run


class Repair(NamedTuple):
    """One row per conversation; the rows of the repaired conversations (place from 0, edit K, R or I)."""

    summary: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", with_turns: bool = False) -> Repair:
    """Audits and repairs every conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256; the repaired rows only `with_turns`."""
    kind = rows.schema[conv].dataType.simpleString()
    ddl = f"conv {kind}, {_DDL}"
    rows = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    initial = F.substring("role", 1, 1)
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumns({
        "kind": F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
        "is_blank": end == "", "is_truncated": (end != "") & ~F.substring(end, -1, 1).isin(".", "!", "?"),
    })
    # the start of a text orders rows as the whole text does
    dealt = rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
    found = written(map_arrow(dealt, _inside(with_turns), ddl), "conversations")

    edges = found.filter("what = 'edge'").select("conv", *_EDGE, "role", "text")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    small = edges.select("conv", "part", "pos", "turn", "kind", "is_blank", "is_truncated", digest.alias("digest"))
    firsts = small.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("part", "pos")).alias("at"))
    small = small.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    row = F.struct("pos", "turn", "kind", "is_blank", "is_truncated", (F.struct("part", "pos") != F.col("at")).alias("duplicate"))
    chunks = small.groupBy("conv", "part", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    chunks = chunks.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    audits = written(map_arrow(chunks, _gathered, ddl), "conversation-audits").select("conv", F.lit(-1).cast("long").alias("part"), F.lit(-1).cast("long").alias("pos"), "role", "text", *_NUMBERS, "audit")
    nothing = [F.lit(None).cast("long").alias(n) for n in _NUMBERS]
    ordered = audits.union(edges.select("conv", "part", "pos", "role", "text", *nothing, F.lit(None).cast("string")))
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "part", "pos")
    ends = written(map_arrow(ordered, _hashed(with_turns), ddl), "conversation-ends")

    both = found.filter("what <> 'edge'").unionByName(ends)
    summary = both.filter("what = 'summary'").select(F.col("conv").alias(conv), *_TYPES)
    return Repair(summary, both.filter("what = 'row'").select(F.col("conv").alias(conv), "place", "edit", "role", "text"))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    out `.!?`, 3 repeats it, 4 makes its role user. Nulls are one space."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("_fault")
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20).alias("_fault"))
        .filter(fault != 0)
        .select(
            "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))),
        ).drop("col")
    )


def audit_damaged(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the undamaged rows; zeros and empty strings where no row is left."""
    ids = conversations.select("conv_id").distinct()
    found = repair(damage(conversations)).summary.withColumnRenamed("conv_id", "_id")
    rows = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    empty = hashlib.sha256(b"").hexdigest()
    return rows.select("conv_id", *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in _NUMBERS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
