import re

import pytest

from quarry.llm import mixing
from tests.llm.fixtures import AWKWARD, docs


def shares(sizes, weights=(5, 2, 1), repeats=3):
    """The contract's loop: what exceeds a cap is shared anew until none does."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    cap, full = {n: repeats * sizes[n] for n in names}, {}
    while True:
        rest = [n for n in names if n not in full]
        left, total = sum(sizes.values()) - sum(full.values()), sum(w[n] for n in rest)
        t = {n: left * w[n] / total for n in rest}
        over = [n for n in rest if t[n] > cap[n]]
        if not over:
            return {**t, **full}
        full.update({n: cap[n] for n in over})


CASES = {
    "plain": {f"s{i}": [10 + i, 20, 3] for i in range(7)},
    "capped": {"a": [1, 2], "b": [500, 20], "c": [30], "d": [2], "e": [900] * 5, None: [7, 7]},
    "hot": {"a": [50] * 60, "b": [3], "é": [4, 4], "z": [1]},
    "empty": {"a": [0, 0], "b": [5], "c": [0]},
}


@pytest.mark.parametrize("name", CASES)
def test_targets_and_what_is_taken(spark, name):
    case = CASES[name]
    rows, i = [], 0
    for s, lengths in case.items():
        for n in lengths:
            rows.append((i, " ".join(["w"] * n), s))
            i += 1
    source = {r[0]: r[2] for r in rows}
    out = mixing.digest(docs(spark, rows)).collect()
    again = mixing.digest(docs(spark, rows).repartition(5)).collect()
    assert sorted(out) == sorted(again)
    want = shares({s: sum(v) for s, v in case.items()})
    taken = dict.fromkeys(case, 0)
    for r in out:
        s = source[r["doc_id"]]
        assert r["target"] == pytest.approx(want[s], abs=1e-9) and r["source_size"] == sum(case[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    # The queue alone decides: a packet or two beside the target.
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.PACKET for s in case)
    assert sum(taken.values()) == sum(map(sum, case.values()))


def test_awkward_rows(spark):
    out = mixing.digest(docs(spark, AWKWARD)).collect()
    assert len(out) == len(AWKWARD)
    assert sorted(r["size"] for r in out) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in AWKWARD)
    assert mixing.digest(docs(spark, [])).count() == 0


def test_repeated_rows_hold_the_words_taken(spark):
    rows = [(i, f"a{i} b  c\n d e", "x" if i < 3 else "y") for i in range(12)] + [(99, "p q", "z"), (None, None, "z")]
    df = docs(spark, rows)
    out = mixing.repeat_rows(df)
    assert out.columns == df.columns
    words = sum(len(r["text"].split()) for r in out.collect())
    assert words == sum(len((t or "").split()) for _, t, _ in rows)
    text = {i: t for i, t, _ in rows}
    for r in out.collect():
        assert text[r["doc_id"]].startswith(r["text"])
        if r["text"] != text[r["doc_id"]]:
            assert r["n_chars"] == len(r["text"])


def test_rows_of_any_column_names(spark):
    names = ["_at", "_n", "_row", "_copy", "row", "at", "of", "size", "taken", "copy", "n", "body", "a.b", "doc_id", "source", "text", "n_chars"]
    rows = [(*[f"v{i}{j}" for j in range(len(names) - 4)], i, "s" if i % 3 else "t", "a b c d", 7) for i in range(9)]
    df = spark.createDataFrame(rows, [f"c{i}" for i in range(len(names))]).toDF(*names)
    out = mixing.repeat_rows(df)
    assert out.columns == names
    assert {tuple(r)[:-4] for r in out.collect()} <= {r[:-4] for r in rows}


def test_queue_equals_a_plain_simulation(spark):
    """Fair queueing with packets, one entry after the other, in Python."""
    import hashlib

    rows, i = [], 0
    for s, lengths in {"a": [30, 400, 9], "b": [5000], "c": [3, 1, 2], "d": [700, 20, 90, 41], None: [60]}.items():
        for n in lengths:
            rows.append((i, " ".join([f"w{i}"] * n), s))
            i += 1
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = shares({s: n for s, n in sizes.items()})
    turn = lambda r: int(hashlib.md5(f"mix|{r[0]}|{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()[:15], 16)
    queue = []
    for s in sizes:
        at = 0
        for _ in range(3):
            for r in sorted((r for r in rows if r[2] == s), key=turn):
                n = len(r[1].split())
                cuts = [n] if at + n <= want[s] else [min(8, n - k) for k in range(0, n, 8)]
                for k in cuts:
                    at += k
                    queue.append((at / want[s], s is None, s or "", r[0], k))
    left, taken = sum(sizes.values()), dict.fromkeys((r[0] for r in rows), 0)
    for _, _, _, d, k in sorted(queue, key=lambda q: q[:3]):
        taken[d] += min(k, left)
        left -= min(k, left)
    got = {r["doc_id"]: r["taken"] for r in mixing.digest(docs(spark, rows)).collect()}
    assert got == taken
