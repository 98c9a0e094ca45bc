"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from quarry.llm import trie

CONV = "conv_id long, turn long, role string, text string, path string, pos int, token string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "t", 2) for r in rows], CONV)


def ordered(rows):
    out = {}
    for c in {r[0] for r in rows if r[0] is not None}:
        mine = sorted((t is not None, t or 0, r or "", hashlib.md5((x or "").encode()).hexdigest(), x or "") for k, t, r, x in rows if k == c)
        out[c] = [(r, x) for _, _, r, _, x in mine]
    return out


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {p: [] for p in members}
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        size = len(p[-1][1].encode()) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * size + sum(saved[k] for k in kids[p])
    return sorted((
        min(members[p]), len(p), min(members[p[:-1]]) if p else -1, len(members[p]), len(kids[p]), leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
    ) for p in members)


def rows_of(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def random_rows(seed):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "", None], ["a", "b", "é", "", None, "long " * 3000]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(roles), rng.choice(texts)) for c in range(-20, 150) for _ in range(rng.randrange(1, 6))]
    rows += [(1000 + c, t, "user", "same") for c in range(300) for t in range(3)]
    rows += [(5000, t, "user", "deep") for t in range(900)] + [(5005, t, "user", "deep") for t in range(800)]
    return rows + [(None, 0, "user", "no id")] + [(7000, 0, "user", "twice")] * 3


@pytest.mark.parametrize("block, fan", [(trie.BLOCK, trie.FAN), (3, 2)])
def test_nodes(spark, monkeypatch, block, fan):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "FAN", fan)
    rows = random_rows(5)
    # Partitions stay as they are, so that spines of several shards merge.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(trie.prefix_trie(frame(spark, rows))) == brute(ordered(rows))
        assert rows_of(trie.digest(frame(spark, rows))) == brute(rebuilt(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_of_one_partition():
    """Any cut of the sorted sequences into blocks gives the same trie."""
    rng = random.Random(6)
    tokens = [bytes([i]) * 16 + i.to_bytes(4, "big") for i in range(3)]
    paths = sorted({b"".join(rng.choice(tokens) for _ in range(rng.randrange(0, 6))) for _ in range(60)})
    rows = [(p, 1 + i % 3, 100 - i, f"sha{i}") for i, p in enumerate(paths)]
    key = lambda nodes: sorted((n["depth"], n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"], n["conv_id"], n["ends_sha256"]) for n in nodes)
    want = key(trie.solve(trie.from_paths(rows), True)[0])
    for _ in range(30):
        cuts = sorted({0, len(rows), *rng.sample(range(len(rows)), 4)})
        final, spine = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            more, own = trie.solve(trie.from_paths(rows[a:b]), False)
            final += more
            spine += own
        assert key(final + trie.solve(trie.from_spines(spine), True)[0]) == want


@pytest.mark.parametrize("seed", range(4))
def test_findclose(seed):
    rng = random.Random(seed)
    parens, height = [1], 1
    deep = rng.choice([0.5, 0.8, 0.95])
    while len(parens) < 6000:
        step = 1 if height == 1 or rng.random() < deep and height < 2500 else -1
        parens.append(step)
        height += step
    parens += [-1] * height
    stack, want = [], {}
    for i, p in enumerate(parens):
        if p == 1:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.array(sorted(want))
    assert trie.Excess(np.array(parens, np.int8)).findclose(opens).tolist() == [want[i] for i in opens]


def test_no_turns_and_empty(spark):
    lone = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, 0, "user", "all of it"), (lone, 1, "user", "goes")]
    assert rows_of(trie.digest(frame(spark, rows))) == brute(rebuilt(rows)) == [
        (lone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())
    ]
    assert trie.digest(frame(spark, [])).count() == 0
