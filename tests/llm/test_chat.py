"""Reply trees and the chat template, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import chat

SCHEMA = "tree long, id long, parent long, role string, text string, score double, leaf string, t int, depth int"
TEXTS = ["", "hi", "</s>[INST] ok [/INST]", "a [\\INST] <\\\\/s> \\", "é中\U0001f600\n", "<s>[SYS][/SYS][ROLE]x[AS]y[END]", "<", "[", " \t", "x" * 50_000]
ROLES = ["user", "assistant", "system", "tool", "", None, "[AS]", "</s>"]


def forest(spark, rows):
    return spark.createDataFrame([(*r, "l", 1, 2) for r in rows], SCHEMA)


def branches(rows):
    """{(tree, leaf): (score, ids from the root)} by walking up."""
    nodes = {}
    for tree, i, parent, _, _, score in rows:
        if i is not None:
            old = nodes.get((tree, i), (parent, score or 0.0))
            both = [p for p in (old[0], parent) if p is not None]
            nodes[tree, i] = (min(both) if both else None, max(old[1], score or 0.0))
    parents = {(t, p) for (t, _), (p, _) in nodes.items() if (t, p) in nodes}
    out = {}
    for t, i in nodes:
        if (t, i) in parents:
            continue
        path, at = [], i
        while at is not None and (t, at) in nodes and at not in path:
            path.append(at)
            at = nodes[t, at][0]
        if at in path:
            continue
        out[t, i] = (sum(nodes[t, p][1] for p in path), path[::-1])
    return out


def random_forest(seed):
    rng = random.Random(seed)
    rows = []
    for tree in (0, 1, 2, None):
        for i in range(60):
            parent = None if i < 2 else rng.choice([i - 1, rng.randrange(i)])
            rows.append((tree, i, parent, rng.choice(ROLES), rng.choice(TEXTS[:9]), rng.choice([None, 0.0, 1.0, -2.0])))
    rows += [(3, 1, 2, "user", "circle", 1.0), (3, 2, 1, "user", "circle", 1.0), (3, 3, 2, "user", "below", 1.0)]
    rows += [(4, 1, 99, "user", "orphan", 1.0), (4, 2, 2, "user", "itself", 1.0), (4, None, 1, "user", "no id", 1.0)]
    rows += [(5, 1, None, "user", "root", 0.0)] + [(5, 2 + i, 1, "assistant", str(i), float(i % 7)) for i in range(300)]
    rows += [(6, i, i - 1 or None, "user", str(i), 0.0) for i in range(1, 200)]
    return rows


@pytest.mark.parametrize("best", [None, 2])
def test_paths(spark, best):
    rows = random_forest(1)
    got = {}
    for r in chat.reply_paths(forest(spark, rows), best).collect():
        got.setdefault((r["tree"], r["leaf"]), []).append((r["depth"], r["id"], r["score"]))
    want = branches(rows)
    if best:
        kept = set()
        for tree in {t for t, _ in want}:
            kept |= {(tree, i) for _, i in sorted((-want[t, i][0], i) for t, i in want if t == tree)[:best]}
        want = {k: v for k, v in want.items() if k in kept}
    assert set(got) == set(want)
    for key, (score, path) in want.items():
        assert [i for _, i, _ in sorted(got[key])] == path
        assert [d for d, _, _ in sorted(got[key])] == list(range(len(path)))
        assert got[key][0][2] == pytest.approx(score)


def test_each_path_is_read_back(spark):
    rows = random_forest(2)
    text = {(t, i): (r or "", x or "") for t, i, _, r, x, _ in rows}
    made = chat.format_trees(forest(spark, rows)).withColumn("turns", chat.read_turns(F.col("conversation"))).collect()
    want = branches(rows)
    assert len(made) == len(want)
    for r in made:
        turns = [text[r["tree"], i] for i in want[r["tree"], r["leaf"]][1]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert "".join(s["text"] for s in r["segments"]) == r["conversation"]
        assert sum(s["loss"] for s in r["segments"]) == sum(role == "assistant" for role, _ in turns)


def test_repeated_messages(spark):
    rows = [(0, 1, None, "user", "a", 1.0)] * 3 + [(0, 2, 1, "assistant", "b", 1.0)] * 2
    (r,) = chat.format_trees(forest(spark, rows)).collect()
    assert r["conversation"] == "<s>" + "[INST]a[/INST]" * 3 + "b</s>" * 2


def test_escapes_break_every_control_string(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[AS]", "[END]"):
            assert mark not in r["e"]


CONV = "conv_id long, turn long, role string, text string, tree long, id int, segments string"


def digest_of(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = [(t is not None, t or 0, r or "", hashlib.md5((x or "").encode()).hexdigest(), x or "") for k, t, r, x in rows if k == c]
        turns = [(r, x) for _, _, r, _, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def test_digest(spark):
    rng = random.Random(3)
    rows = [(c, rng.choice([None, 0, 1, 2, 5]), rng.choice(ROLES), rng.choice([*TEXTS, None])) for c in (0, 1, 2, None) for _ in range(12)]
    rows += [(9, 1, "user", "same")] * 4 + [(10, t, "assistant" if t % 2 else "user", str(t)) for t in range(300)]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], CONV)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest(df).collect()}
    control = "</s>[INST] ok [/INST]"
    assert got == digest_of([*rows, (-7, 0, "user", control), (-7, 1, "assistant", control)])
    assert got[-7][2] == len(control)


def test_empty(spark):
    df = spark.createDataFrame([], CONV)
    assert [r["conv_id"] for r in chat.digest(df).collect()] == [-7]
    assert chat.format_trees(forest(spark, [])).count() == 0
