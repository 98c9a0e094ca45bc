import collections
import random

import numpy as np
import pytest

from quarry.llm import ngram_join
from tests.llm.fixtures import AWKWARD, docs


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(component, links) per row, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = collections.Counter()
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                links.update((a, b))
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return collections.Counter(
        (k, len(sets[i]), low[find(i)] if k is not None else None, links[i]) for i, (k, _) in enumerate(rows)
    )


def got(df):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in df.collect())


def corpus(seed, base=6, copies=12, length=40):
    """Copies of a few texts with some words changed: links, near misses, chains."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    texts = [[word() for _ in range(length)] for _ in range(base)]
    passage = [word() for _ in range(25)]
    rows = []
    for i in range(base * copies):
        t = list(texts[i % base])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = word()
        if rng.random() < 0.2:
            t = t[: rng.randrange(3, length)] + passage
        rows.append((1000 - i, " ".join(t).upper() if rng.random() < 0.2 else "  ".join(t)))
    return rows + [(i, " ".join(passage)) for i in range(3)] + [(5000 + i, "two words") for i in range(3)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rows = [*corpus(seed), *AWKWARD]
    assert got(ngram_join.digest(docs(spark, rows).repartition(3))) == brute(rows)


def test_clusters_in_several_blocks_and_fragments(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 7)
    # The cells run in Python workers, which import the module anew: the
    # fragment size is tested on the function itself below.
    rows = corpus(9, base=2, copies=40)
    assert got(ngram_join.digest(docs(spark, rows))) == brute(rows)


def test_overlaps_summed_over_fragments(monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.choice(1000, 120, replace=False)
    sets = [np.unique(np.where(rng.random(120) < 0.05, rng.integers(0, 1000, 120), base)).astype(np.uint64) for _ in range(30)]
    size = np.array([len(s) for s in sets])
    every = np.arange(len(sets))
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    for fragment in (4096, 50, 7):
        monkeypatch.setattr(ngram_join, "FRAGMENT", fragment)
        found = ngram_join.overlaps(sets, size, every, every)
        assert (found == want)[~np.eye(len(sets), dtype=bool)].all()


def test_a_chain_across_documents(spark):
    # Each text links with its neighbours only.
    words = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(30)]
    want = brute(rows)
    assert {k[2] for k in want} == {0}
    assert got(ngram_join.digest(docs(spark, rows))) == want


def test_empty_table_and_unique_texts(spark):
    assert ngram_join.digest(docs(spark, [])).count() == 0
    rows = [(i, f"text number {i} stands alone here {i * i}") for i in range(20)]
    assert got(ngram_join.digest(docs(spark, rows))) == brute(rows)


def test_keep_one_of_each_component(spark):
    rows = [*corpus(4), *[(i if i is None else i + 9000, t) for i, t in AWKWARD]]
    df = docs(spark, rows)
    out = ngram_join.keep_one(df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    components = {}
    for k, n, c, links in ngram_join.digest(docs(spark, [r for r in rows if r[0] is not None])).select(
        "doc_id", "n_shingles", "component_id", "n_links"
    ).collect():
        components.setdefault((c, n == 0), set()).add(k)
    ids = collections.Counter(k for k, _ in kept)
    for (c, blank), members in components.items():
        assert ids[c] >= 1 and (blank or sum(ids[k] for k in members) == 1)
    assert (None, None) in kept and (None, "no id here") in kept
