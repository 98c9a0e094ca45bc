"""The repair automaton against an exhaustive search and a plain simulation."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from quarry.llm import repair

BLANKS = " \t\n\r\x0b\x0c"
CONV = "conv_id long, turn long, role string, text string, head string, h string, symbol string, again int"


def symbol(initial, fault):
    return repair.SYMBOLS[4 * repair.INITIALS.index(initial) + repair.FAULTS.index(fault)]


def cheapest(rows):
    """(cost, audit) of (initial, fault) rows by trying every edit."""
    @cache
    def go(i, state, puts):
        emit, to = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}[state]
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if puts < 3:
            found.append(add(3, "I", go(i, to, puts + 1)))
        if i < len(rows):
            initial, fault = rows[i]
            found.append(add(4, "D", go(i + 1, state, 0)))
            if fault not in "BD":
                extra = 3 if fault == "T" else 0
                found.append(add(3 + extra, "R", go(i + 1, to, 0)))
                if initial == emit:
                    found.append(add(extra, "K", go(i + 1, to, 0)))
                if initial == "s" and state == 0:
                    found.append(add(extra, "K", go(i + 1, 1, 0)))
        return min(found, default=(10**9, ""))

    def add(cost, letter, rest):
        return cost + rest[0], letter + rest[1]

    return go(0, 0, 0)


def solve(rows):
    chain = [repair.END]
    for initial, fault in reversed(rows):
        chain.append(repair.node(symbol(initial, fault), chain[-1]))
    return chain[-1][0][0][0], repair.audit(chain)


def test_every_short_signature():
    kinds = list(itertools.product("sua?", "-BT"))
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert solve(rows) == cheapest(rows), rows


def test_longer_signatures():
    rng = random.Random(1)
    for _ in range(400):
        rows = tuple((rng.choice("suuaa?"), rng.choice("----BDT")) for _ in range(rng.randrange(4, 14)))
        assert solve(rows) == cheapest(rows), rows


def test_shared_suffixes(spark):
    rng = random.Random(2)
    found = {"".join(rng.choice("AEIEIEIGK") for _ in range(rng.randrange(0, 9))) for _ in range(500)} - {""}
    df = spark.createDataFrame([(s,) for s in found for _ in range(2)], "signature string")
    got = {r["signature"]: (r["cost"], r["audit"]) for r in repair.solved(df).collect()}
    pairs = lambda s: tuple((repair.INITIALS[repair.SYMBOLS.index(c) // 4], repair.FAULTS[repair.SYMBOLS.index(c) % 4]) for c in s)
    assert got == {s: cheapest(pairs(s)) for s in found}


def hurt(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        spelled = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        fate = zlib.crc32(spelled.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (c, turn, "user" if fate == 4 else role, text)
        out += [row] * (2 if fate == 3 else 1)
    return out


def expected(rows):
    out = {c: None for c in {r[0] for r in rows}}
    rows = hurt(rows)
    for c in out:
        mine = sorted(
            ((t is not None, t or 0, r, hashlib.md5(x.encode()).hexdigest(), x) for k, t, r, x in rows if k == c),
        )
        seen, marks = set(), []
        for _, _, role, _, text in mine:
            body = text.strip(BLANKS)
            fault = "B" if not body else "D" if (role, text) in seen else "-" if body[-1] in ".!?" else "T"
            seen.add((role, text))
            marks.append((role[:1] if role[:1] in set("sua") and role else "?", fault))
        turns = [t for known, t, *_ in mine if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:], strict=False))
        cost, audit = solve(tuple(marks)) if len(marks) > 14 else cheapest(tuple(marks))
        lines, queue, last = [], iter(mine), ""
        for letter in audit:
            if letter == "I":
                role, text = "", ""
            else:
                _, _, role, _, text = next(queue)
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        faults = [f for _, f in marks]
        out[c] = (gaps, faults.count("B"), faults.count("D"), faults.count("T"), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


TEXTS = ["Yes.", "No!", "why", "a?  \n", "", "  ", None, "é中。", "x" * 30_000 + "."]
ROLES = ["user", "user", "assistant", "assistant", "system", "tool", "", None]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(c, rng.choice([None, *range(8)]), rng.choice(ROLES), rng.choice(TEXTS)) for c in [*range(60), None] for _ in range(rng.randrange(1, 12))]
    out += [(100, 1, "user", "same.")] * 40
    out += [(101, t, "assistant" if t % 2 else "user", f"turn {t}.") for t in range(3000)]
    out += [(200 + c, 0, "user", "Hi.") for c in range(300)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], CONV)


def test_digest(spark, rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = repair.digest(frame(spark, rows)).collect()
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[n] for n in names) == want[r["conv_id"]], r["conv_id"]


def test_repaired_turns_fit_the_grammar(spark, rows):
    hit = {}
    for r in repair.repaired(frame(spark, rows)).collect():
        hit.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"], r["source_turn"]))
    for made in hit.values():
        made.sort()
        assert [m[0] for m in made] == list(range(len(made)))
        assert re.fullmatch("(s?(ua)+)?", "".join(m[1][0] for m in made))
        assert all(m[2] == "" and m[4] is None for m in made if m[3] == "I")


def test_nothing_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (r,) = repair.digest(frame(spark, [(gone, 0, "user", "Hi.")])).collect()
    assert (r["cost"], r["audit"], r["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())
    assert repair.digest(frame(spark, [])).count() == 0
