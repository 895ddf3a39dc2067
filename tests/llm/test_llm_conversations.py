"""Conversation repair against plain dynamic programming over (cost, letters)."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from stationcast.llm import conversations as C

CONV = "conv_id long, turn long, role string, text string, cost string, edit string, part long"


def cheapest(symbols):
    """(cost, letters) by trying every edit at every row, from the last to the first, ties by the letters."""
    to = {"-": "u", "s": "u", "u": "a", "a": "u"}

    def closed(own):
        for _ in range(3):
            own = {q: min(own[q], (own[to[q]][0] + 5, "I" + own[to[q]][1])) for q in to}
        return own

    never = (10**9, "")
    after = closed({"-": (0, ""), "s": never, "u": never, "a": (0, "")})
    for role, gone, cut in reversed(symbols):
        own = {}
        for q in to:
            steps = [(2, "D", q)]
            if not gone:
                steps.append((1 + 5 * cut, "R", to[q]))
                if role == to[q] or (role == "s" and q == "-"):
                    steps.append((5 * cut, "K", role))
            own[q] = min((after[n][0] + c, x + after[n][1]) for c, x, n in steps)
        after = closed(own)
    return after["-"]


def audit(rows):
    """A conversation's result, by the contract, from its rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        t = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    symbols = tuple((r[:1] if r[:1] in ("s", "u", "a") else "o", f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(rows, faults))
    cost, letters = cheapest(symbols)
    out, left, state = [], iter(rows), "-"
    for x in letters:
        if x == "I":
            role, text = "", ""
        else:
            _, role, text = next(left)
            if x == "D":
                continue
        if x == "K":
            state = role[:1]
        else:
            state = "a" if state == "u" else "u"
            role = {"u": "user", "a": "assistant"}[state]
        out.append((x, role, text))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, digest), out


def in_order(rows):
    return sorted(((t, r, x) for _, t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k:
            row = (c, t, "user" if k == 4 else r, "" if k == 1 else x.translate({ord(y): None for y in ".!?"}) if k == 2 else x)
            out += [row] * (2 if k == 3 else 1)
    return out


def symbol(row):
    role, gone, cut = row
    return 0 if gone else 1 + 2 * "suao".index(role) + cut


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suao"), st.sampled_from([False, False, True]), st.sampled_from([False, False, True])), max_size=14), st.integers(1, 5))
def test_blocks_give_the_cheapest_least_letters(rows, block):
    assert C.BlockTables(block).solve(bytes(map(symbol, rows))) == cheapest(tuple(rows))


def test_few_vectors_and_long_sequences():
    tables, rng = C.BlockTables(), random.Random(5)
    assert len(tables.vectors) < 100 and len(tables.over[0]) == C.SYMBOLS**C.BLOCK
    rows = [(rng.choice("suuaao"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(300)]
    assert tables.solve(bytes(map(symbol, rows))) == cheapest(tuple(rows))
    cost, letters = tables.solve(bytes(symbol(r) for r in rows) * 1000)
    assert cost > 0 and sum(x != "I" for x in letters) == 300_000


def sample(seed=2):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "three", "", " \n\t", "Why?  \n", "\xa0", "nothing. \xa0", "One."]
    rows = []
    for c in [*range(40), None]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None, t + 3]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]), rng.choice([*texts, None])))
    rows += [(50, t, ("user", "assistant")[t % 2], f"text {t % 700}" + "." * (t % 3)) for t in range(9000)]  # hot
    rows += [(51, None, "user", "same.")] * 300 + [(52, 7, "user", "tie."), (52, 7, "assistant", "tie."), (52, 7, "assistant", "Tie.")]
    rng.shuffle(rows)
    return rows


def test_repair_of_all_kinds_of_rows(spark, monkeypatch):
    rows = sample()
    frame = spark.createDataFrame([(*r, "x", "x", 1) for r in rows], CONV).repartition(5)
    for held in (4096, 20):
        monkeypatch.setattr(C, "HELD_ROWS", held)
        monkeypatch.setattr(C, "CHUNK", held)
        found = C.repair(C.damage(frame), with_turns=True)
        got = {r[0]: tuple(r)[1:] for r in found.summary.collect()}
        turns = {}
        for r in found.turns.collect():
            turns.setdefault(r.conv_id, []).append((r.place, r.edit, r.role, r.text))
        after = {}
        for r in damaged(rows):
            after.setdefault(r[0], []).append(r)
        assert got.keys() == after.keys()
        for c, own in after.items():
            want, made = audit(in_order(own))
            assert got[c] == want, c
            assert [t[1:] for t in sorted(turns.get(c, []))] == made


def test_every_conversation_has_a_row(spark):
    rows = [(c, 0, "user", "Alone.") for c in range(60)] + [(None, None, None, None)]
    got = {r.conv_id: r for r in C.audit_damaged(spark.createDataFrame([(*r, "x", "x", 1) for r in rows], CONV)).collect()}
    gone = [c for c, *_ in rows if not damaged([r for r in rows if r[0] == c])]
    assert len(got) == 61 and gone
    assert all(tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    assert C.audit_damaged(spark.createDataFrame([], CONV)).count() == 0
