r"""Conversation structure repair with a suffix-shared automaton.

Each conversation's rows, by turn, become a signature: one symbol per row for
its role's initial and its fault. Signatures are minimised from the end: one
automaton node per distinct suffix. A node holds, for each state of the target
grammar ``(s?(ua)+)?``, the cost-to-go and the best audit suffix (a letter and
a link to the node and state that follow).

How it runs: a window finds repeated rows, so no group is collected; rows
sorted by conversation are read as a stream into signatures; distinct
signatures are range-sorted by their reverse, so equal suffixes lie next to
each other, and one pass keeps the nodes of the current suffix chain: every
suffix of a range is solved once for all conversations that end in it. The
audits then stream together with the texts, again by conversation. Texts are
shuffled once, as the first two steps carry md5 sums.

Edits and costs: Keep 0, Rerole to user or assistant 3, Delete 4 (required for
blank and duplicate rows), Insert an empty user or assistant turn 3; a
truncated row that stays costs 3 more. Equal costs take the ASCII-least audit.

Defined cases: null roles and texts are one space; rows sort by turn (null
first), then role, then md5 of the text; a null conv_id is a conversation; a
role without first character, or with one other than s, u, a, can't be kept;
repeated rows are duplicates; conversations without rows give zeros, an empty
audit and the hash of an empty string; an empty table gives an empty result;
further columns are left out. A conversation's symbols and audit must fit into
one row, its texts need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import map_batches
from quarry.llm.common import SPACE, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  #: fixed values: costs
INITIALS, FAULTS = "sua?", "-BDT"  #: a symbol is the letter of 4 * initial + fault
SYMBOLS = "ABCDEFGHIJKLMNOP"
#: Grammar states: at the start, after s, after u, after a. The initial that
#: each can emit (s aside), and where that leads.
EMITS, NEXT = "uuau", (2, 2, 3, 2)
LEGAL = {"su", "ua", "au"}
HEAD = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
#: The automaton's last node: (cost, letter, next state) and the rank of the audit among the states.
END = (((0, "", 0), (6, "I", 2), (3, "I", 3), (0, "", 3)), (0, 2, 1, 0))


def node(symbol: str, below: tuple) -> tuple:
    """The node of ``symbol`` before the suffix of node ``below``."""
    initial, fault = INITIALS[SYMBOLS.index(symbol) // 4], FAULTS[SYMBOLS.index(symbol) % 4]
    after, ranks = below
    best = []
    for state in range(4):
        options = [(DELETE + after[state][0], "D", ranks[state], state)]
        if fault not in "BD":
            extra, to = TRUNCATED * (fault == "T"), NEXT[state]
            options.append((REROLE + extra + after[to][0], "R", ranks[to], to))
            kept = to if initial == EMITS[state] else 1 if initial == "s" and state == 0 else None
            if kept is not None:
                options.append((KEEP + extra + after[kept][0], "K", ranks[kept], kept))
        best.append(min(options))
    changed = True
    while changed:
        changed = False
        for state in (2, 3, 0, 1):
            put = (INSERT + best[NEXT[state]][0], "I")
            if put < best[state][:2]:
                best[state], changed = (*put, -1, NEXT[state]), True

    def order(state: int) -> tuple:  # the audit's place among this node's
        _, letter, rank, to = best[state]
        return (letter, order(to) if letter == "I" else rank)

    orders = [order(s) for s in range(4)]
    places = sorted(set(orders))
    return tuple((c, letter, to) for c, letter, _, to in best), tuple(places.index(o) for o in orders)


def audit(chain: list[tuple]) -> str:
    """The best audit from the chain's last node, in the state at the start."""
    out, at, state = [], len(chain) - 1, 0
    while True:
        _, letter, to = chain[at][0][state]
        if not letter:
            return "".join(out)
        out.append(letter)
        at, state = at - (letter != "I"), to


def _solve(batches) -> Iterator[dict]:
    chain, last = [END], ""
    for b in batches:
        rows = []
        for signature in b.column("signature").to_pylist():
            back = signature[::-1]
            same = 0
            while same < len(last) and same < len(back) and last[same] == back[same]:
                same += 1
            del chain[same + 1:]
            for symbol in back[same:]:
                chain.append(node(symbol, chain[-1]))
            last = back
            initials = [INITIALS[SYMBOLS.index(c) // 4] for c in signature]
            faults = [FAULTS[SYMBOLS.index(c) % 4] for c in signature]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            rows.append((signature, *(faults.count(f) for f in "BDT"), illegal, chain[-1][0][0][0], audit(chain)))
        names = ("signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h, again, symbol) of conversation rows."""
    texts = _clean(rows).withColumn("h", F.md5("text"))
    full, whole = F.col("text").rlike(rf"[^{SPACE}]"), F.col("text").rlike(rf"[.!?][{SPACE}]*+\z")
    seen = Window.partitionBy("conv_id", "role", "h").orderBy(F.col("turn").asc_nulls_first())
    light = texts.select("conv_id", "turn", "role", "h", full.alias("full"), whole.alias("whole"))
    light = light.withColumn("again", F.row_number().over(seen) > 1)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    fault = F.when(~F.col("full"), 1).when(F.col("again"), 2).when(~F.col("whole"), 3).otherwise(0)
    return light.select("conv_id", "turn", "role", "h", "again", F.substring(F.lit(SYMBOLS), kind + fault + 1, F.lit(1)).alias("symbol"))


def _clean(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, signature), one row per conversation of ``rows``."""
    by_turn = F.col("turn").asc_nulls_first()
    lined = marked(rows).repartition("conv_id").sortWithinPartitions("conv_id", by_turn, "role", "h", "again")

    def run(batches):
        def close():
            gaps = last - first + 1 - turns if turns else 0
            return conv, gaps, "".join(symbols)

        conv, symbols, first, last, turns, any_row = None, [], None, None, 0, False
        for b in batches:
            out = []
            for c, turn, symbol in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "symbol")), strict=True):
                if not any_row or c != conv:
                    if any_row:
                        out.append(close())
                    conv, symbols, first, last, turns, any_row = c, [], None, None, 0, True
                symbols.append(symbol)
                if turn is not None and turn != last:
                    first, last, turns = (turn if turns == 0 else first), turn, turns + 1
            yield _columns(out)
        if any_row:
            yield _columns([close()])

    def _columns(out):
        return {"conv_id": [r[0] for r in out], "gaps": [r[1] for r in out], "signature": [r[2] for r in out]}

    return map_batches(lined.select("conv_id", "turn", "symbol"), run, "conv_id long, gaps long, signature string")


def solved(found: DataFrame) -> DataFrame:
    """Costs and audits of the distinct signatures of ``found``."""
    distinct = found.select("signature").distinct()
    back = F.reverse("signature")
    lined = distinct.repartitionByRange(F.substring(back, 1, 64), F.xxhash64("signature")).sortWithinPartitions(back)
    return map_batches(
        lined, _solve,
        "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )


def audits(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of
    every conversation of ``ids`` (conv_id); zeros for those without rows."""
    found = written(signatures(rows), "repair-signatures")
    nodes = solved(found).withColumnRenamed("signature", "known")
    per = found.join(nodes, F.col("signature") == F.col("known")).withColumnRenamed("conv_id", "c")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.select("conv_id").distinct().join(per, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
    )


def _stream(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Every conversation's audit row, then its rows in order."""
    columns = [f.split()[0] for f in HEAD.split(", ")]
    top = heads.select("conv_id", F.struct(*columns).alias("head"))
    body = _clean(rows).select("conv_id", "turn", "role", F.md5("text").alias("h"), "text")
    return (
        body.unionByName(top, allowMissingColumns=True).repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("head").isNull(), F.col("turn").asc_nulls_first(), "role", "h")
        .select("conv_id", "head", "turn", "role", "text")
    )


class _Edits:
    """Applies an audit to the rows of a conversation, one after the other."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state = letters, 0, 0

    def _emit(self) -> str:
        role = "assistant" if EMITS[self.state] == "a" else "user"
        self.state = NEXT[self.state]
        return role

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.letters[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._emit(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            yield letter, self._emit(), text
        elif letter == "K":
            self.state = 1 if role[0] == "s" else NEXT[self.state]
            yield letter, role, text


def repaired(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The repaired turns: (conv_id, place, edit, source_turn, role, text),
    ``place`` from 0; ``source_turn`` is null for inserted ones."""
    heads = audits(rows, rows if ids is None else ids)

    def run(batches):
        edits, place, conv = None, 0, None
        for b in batches:
            out = []

            def add(made, turn, out=out):
                nonlocal place
                for letter, role, text in made:
                    out.append((conv, place, letter, None if letter == "I" else turn, role, text))
                    place += 1

            for c, head, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if head is not None:
                    if edits is not None:
                        add(edits.inserted(), None)
                    edits, place, conv = _Edits(head["audit"]), 0, c
                else:
                    add(edits.row(role, text), turn)
            yield {n: [r[i] for r in out] for i, n in enumerate(("conv_id", "place", "edit", "source_turn", "role", "text"))}
        if edits is not None:
            out = [(conv, place + i, letter, None, role, text) for i, (letter, role, text) in enumerate(edits.inserted())]
            yield {n: [r[i] for r in out] for i, n in enumerate(("conv_id", "place", "edit", "source_turn", "role", "text"))}

    return map_batches(_stream(rows, heads), run, "conv_id long, place long, edit string, source_turn long, role string, text string")


def summary(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps, fault counts, cost, audit and the hash of the
    repaired ``role:text`` lines."""
    heads = audits(rows, rows if ids is None else ids)
    names = [f.split()[0] for f in HEAD.split(", ")]

    def run(batches):
        def close():
            add(edits.inserted())
            return {"conv_id": conv, **head, "repaired_sha256": sha.hexdigest()}

        def add(made):
            nonlocal lines
            for _, role, text in made:
                sha.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1

        head = edits = conv = sha = None
        lines = 0
        for b in batches:
            out = []
            for c, top, _turn, role, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if top is not None:
                    if head is not None:
                        out.append(close())
                    head, conv, lines, sha, edits = top, c, 0, hashlib.sha256(), _Edits(top["audit"])
                else:
                    add(edits.row(role, text))
            yield _columns(out)
        if head is not None:
            yield _columns([close()])

    def _columns(out):
        return {n: [r[n] for r in out] for n in ("conv_id", *names, "repaired_sha256")}

    return map_batches(_stream(rows, heads), run, f"conv_id long, {HEAD}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows that the query repairs: dropped, emptied, cut of their end
    marks, repeated or given to the user by crc32 of ``conv_id:turn``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = _clean(conversations).withColumn("fate", fate)
    copies = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def digest(conversations: DataFrame) -> DataFrame:
    return summary(damaged(conversations), conversations.select(F.col("conv_id").cast("long").alias("conv_id")))


def _options(state: int) -> str:
    """SQL: the cheapest cost and audit (ASCII-least) without an insert in
    front, as zero-padded cost and letters, from the states below."""
    to = NEXT[state]
    plus = lambda cost, letter, s: (
        f"lpad((left(s{s}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr(s{s}, 10)"
    )
    extra = f"CASE fault WHEN 'T' THEN {TRUNCATED} ELSE 0 END"
    kept = [f"CASE WHEN fault NOT IN ('B', 'D') AND initial = '{EMITS[state]}' THEN {plus(f'{KEEP} + {extra}', 'K', to)} END"]
    if state == 0:
        kept.append(f"CASE WHEN fault NOT IN ('B', 'D') AND initial = 's' THEN {plus(f'{KEEP} + {extra}', 'K', 1)} END")
    rerole = f"CASE WHEN fault NOT IN ('B', 'D') THEN {plus(f'{REROLE} + {extra}', 'R', to)} END"
    return f"least({plus(DELETE, 'D', state)}, {rerole}, {', '.join(kept)})"


def _insert(target: str) -> str:
    return f"lpad((left({target}, 9)::BIGINT + {INSERT})::VARCHAR, 9, '0') || 'I' || substr({target}, 10)"


ORACLE_SQL = rf"""
WITH RECURSIVE clean AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS spelled FROM conversations),
bits AS (SELECT i::UBIGINT AS i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT),
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS v FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM bits),
fated AS (
  SELECT c.*, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(spelled, ''), lambda x: ascii(x)::UBIGINT),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 20 AS fate
  FROM clean c, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) t(copy)),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM hurt),
lined AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), nth) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS initial,
    CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'B' WHEN nth > 1 THEN 'D'
         WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*\z') THEN 'T' ELSE '-' END AS fault
  FROM seen),
steps AS (
  SELECT conv_id, n AS spot, '000000000' AS s0, '000000006II' AS s1, '000000003I' AS s2, '000000000' AS s3 FROM lined WHERE pos = n
  UNION ALL
  SELECT conv_id, spot, least(o0, {_insert("p2")}), least(o1, {_insert("p2")}), p2, p3 FROM (
    SELECT conv_id, spot, o0, o1, least(o2, {_insert("o3")}) AS p2, least(o3, {_insert("o2")}) AS p3 FROM (
      SELECT conv_id, spot - 1 AS spot, {", ".join(f"{_options(i)} AS o{i}" for i in range(4))}
      FROM steps JOIN (SELECT conv_id AS c, pos, initial, fault FROM lined) l ON steps.conv_id IS NOT DISTINCT FROM c AND pos = spot))),
best AS (SELECT conv_id, left(s0, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM steps WHERE spot = 0),
edits AS (
  SELECT conv_id, i, substr(audit, i, 1) AS edit,
    sum(CASE WHEN substr(audit, i, 1) = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS pos,
    sum(CASE WHEN substr(audit, i, 1) = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS place
  FROM best, range(1, len(audit) + 1) t(i)),
made AS (
  SELECT e.conv_id, e.i, e.edit, e.place, l.role, l.text, l.initial,
    max(CASE WHEN e.edit = 'K' AND l.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM edits e JOIN lined l ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND l.pos = greatest(e.pos, 1)),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS body
  FROM made WHERE edit <> 'D' GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'B') AS blank, count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
    count(*) FILTER (bad) AS illegal
  FROM (SELECT *, pos < n AND (initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY pos)) NOT IN ('su', 'ua', 'au') AS bad FROM lined)
  GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON i.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON i.conv_id IS NOT DISTINCT FROM t.conv_id
"""
