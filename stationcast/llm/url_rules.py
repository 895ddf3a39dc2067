"""Verdicts for URLs from glob rules, all of them simulated at once by one bit-parallel automaton.

A glob is matched against the whole canonical URL, `host` + `path`: `*` stands for any run of characters but
`/`, `**` for any run, `?` for one character but `/`. A host rule such as `block example.org/es/` becomes the
two globs `example.org/es/**` and `*.example.org/es/**`. All globs lie one after another in a multiword bit
mask: a bit for the start of each glob and one for each of its characters. One step of the automaton shifts the
whole mask, keeps the bits whose glob accepts the character there, and keeps the bits that stand at a star that
accepts it. The batch's URLs advance together, one character at a time; those that have ended drop out.

Defined results: a null URL or one without `://` has empty host and path, which no rule with a host fits; of
several rules that fit, the longest wins, of equally long ones the first; without one the verdict is `default`.
Repeated URLs are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow

#: (verdict, host and path): a rule fits its host and all subdomains, and paths that start with its path.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


def host_globs(rule: str) -> tuple[str, str]:
    return f"{rule}**", f"*.{rule}**"


@dataclass(frozen=True)
class Automaton:
    """Masks of 64-bit words. codes: the sorted characters that some glob names; the last row of `accept` and
    `hold` is for all other characters, the last but one for `/` where no glob names it."""

    codes: np.ndarray
    accept: np.ndarray
    hold: np.ndarray
    start: np.ndarray
    final: np.ndarray
    rule_of: np.ndarray  # rule of each final bit
    final_bit: np.ndarray


def compiled(globs: list[tuple[str, int]]) -> Automaton:
    """globs: (glob, number of its rule)."""
    steps: list[tuple[int, str | None]] = []  # per bit: its character, or None for a start
    stars: dict[int, str] = {}
    starts, finals, rules = [], [], []
    for glob, rule in globs:
        starts.append(len(steps))
        steps.append((len(steps), None))
        i = 0
        while i < len(glob):
            if glob[i] == "*":
                both = glob[i : i + 2] == "**"
                at = len(steps) - 1
                stars[at] = "**" if both or stars.get(at) == "**" else "*"
                i += 1 + both
            else:
                steps.append((len(steps), glob[i]))
                i += 1
        finals.append(len(steps) - 1)
        rules.append(rule)
    words = max(1, -(-len(steps) // 64))
    codes = np.array(sorted({ord(c) for _, c in steps if c not in (None, "?")} | {ord("/")}), np.uint32)
    accept, hold = np.zeros((len(codes) + 1, words), np.uint64), np.zeros((len(codes) + 1, words), np.uint64)
    slash = int(np.searchsorted(codes, ord("/")))
    other = np.arange(len(codes) + 1) != slash

    def put(mask: np.ndarray, rows, bit: int) -> None:
        mask[rows, bit // 64] |= np.uint64(1 << bit % 64)

    for bit, c in steps:
        if c == "?":
            put(accept, other, bit)
        elif c is not None:
            put(accept, int(np.searchsorted(codes, ord(c))), bit)
        if bit in stars:
            put(hold, slice(None) if stars[bit] == "**" else other, bit)
    start, final = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for bits, mask in ((starts, start), (finals, final)):
        for bit in bits:
            mask[bit // 64] |= np.uint64(1 << bit % 64)
    return Automaton(codes, accept, hold, start, final, np.array(rules), np.array(finals))


def first_rule(a: Automaton, urls: list[str], n_rules: int) -> np.ndarray:
    """The smallest number of a rule that fits each canonical URL; n_rules where none does."""
    lengths = np.array([len(u) for u in urls], np.int64)
    order = np.argsort(-lengths, kind="stable")
    text = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(urls) else lengths
    kind = np.searchsorted(a.codes, text)
    kind[(kind == len(a.codes)) | (a.codes[np.minimum(kind, len(a.codes) - 1)] != text)] = len(a.codes)
    state = np.repeat(a.start[None, :], len(urls), axis=0)
    offsets, longest = offsets[order], lengths[order]
    alive = len(urls)
    for i in range(int(longest[0]) if len(urls) else 0):
        alive = int(np.searchsorted(-longest[:alive], -i, "left"))  # those longer than i
        now, c = state[:alive], kind[offsets[:alive] + i]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        state[:alive] = (moved & a.accept[c]) | (now & a.hold[c])
    best = np.full(len(urls), n_rules, np.int64)
    for bit, rule in zip(a.final_bit, a.rule_of):
        hit = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) != 0
        best[hit] = np.minimum(best[hit], rule)
    out = np.empty(len(urls), np.int64)
    out[order] = best
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in (rest.find("?"), rest.find("#")) if i >= 0]
    rest = rest[: min(ends)] if ends else rest
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(65, 91)}


def judge_urls(
    pages: DataFrame, *, url: str = "url", rules=RULES, default: str = "allow", keep: tuple[str, ...] = ("page_id",), batch_chars: int = 1 << 20,
) -> DataFrame:
    """`keep` and the columns host, path, rule, verdict, one row per row. rules: (verdict, host and path)."""
    ranked = sorted(rules, key=lambda r: -len(r[1]))  # stable: of equally long rules the first
    automaton = compiled([(g, i) for i, (_, rule) in enumerate(ranked) for g in host_globs(rule)])
    names = [rule for _, rule in ranked] + [None]
    verdicts = [verdict for verdict, _ in ranked] + [default]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(len(keep)).to_pylist()]
            best, begin, size = [], 0, 0
            for i, (host, path) in enumerate(parts):
                size += len(host) + len(path)
                if size >= batch_chars or i == len(parts) - 1:
                    best += first_rule(automaton, [h + p for h, p in parts[begin : i + 1]], len(ranked)).tolist()
                    begin, size = i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                 pa.array([names[b] for b in best], pa.string()), pa.array([verdicts[b] for b in best], pa.string())],
                [*keep, "host", "path", "rule", "verdict"],
            )

    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    rows = pages.select(*[F.col(c) for c in keep], F.col(url).alias("__url"))
    return map_arrow(rows, judged, f"{kept}, host string, path string, rule string, verdict string")
