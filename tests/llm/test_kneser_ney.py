import collections
import math
import zlib

import numpy as np
import pytest

from quarry.llm import kneser_ney, tokens
from tests.llm.fixtures import AWKWARD, docs

START, END = "<start>", "<end>"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


class Brute:
    """The same model from dictionaries."""

    def __init__(self, texts):
        seqs = [words(t) for t in texts]
        self.c = collections.Counter(w for s in seqs for w in s)
        self.pair = collections.Counter(p for s in seqs for p in zip([START, *s], s))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.context, self.classes, self.before = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
        for (u, w), c in self.pair.items():
            self.context[u] += c
            self.classes[u][min(c, 3) - 1] += 1
            self.before[w] += 1
        at = lambda counts: [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
        self.t, self.m = at(self.pair), at(self.before)
        self.d2, self.d1 = [0, *kneser_ney.discounts(self.t)], [0, *kneser_ney.discounts(self.m)]

    def low(self, w):
        if not self.pair:
            return 1 / (self.v + 1)
        k, pairs = self.before[w], len(self.pair)
        rest = self.d1[1] * self.m[0] + self.d1[2] * self.m[1] + self.d1[3] * (self.v - self.m[0] - self.m[1])
        return max(k - self.d1[min(k, 3)], 0) / pairs + rest / pairs / (self.v + 1)

    def p(self, u, w):
        if not self.context[u]:
            return self.low(w)
        c = self.pair[u, w]
        rest = sum(self.d2[j + 1] * self.classes[u][j] for j in range(3)) / self.context[u]
        return max(c - self.d2[min(c, 3)], 0) / self.context[u] + rest * self.low(w)


def check(spark, rows):
    out = kneser_ney.digest(docs(spark, rows)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    b = Brute([t for i, t in rows if not held(i)])
    assert len(out) == len(rows)
    want = collections.Counter()
    for i, t in rows:
        s = words(t)
        base = sum(math.log10((b.c[w] + 0.5) / (b.n + 0.5 * (b.v + 1))) for w in s)
        score = sum(math.log10(b.p(u, w)) for u, w in zip([START, *s], s))
        want[(i, held(i), len(s), sum(b.c[w] > 0 for w in s), b.n, f"{base:.5f}", f"{score:.5f}")] += 1
    got = collections.Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], f"{r['base_score']:.5f}", f"{r['score']:.5f}") for r in out
    )
    assert got == want
    return b


def test_equals_brute_force_and_sums_to_one(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 40)), p=np.arange(60, 0, -1) / 1830))) for i in range(120)]
    b = check(spark, [*rows, *AWKWARD])
    for u in (START, "w0", "w5", "never"):
        assert sum(b.p(u, w) for w in b.c) + b.p(u, "unknown") == pytest.approx(1)


def test_few_and_no_training_rows(spark):
    check(spark, [(1, "a b a b")])
    check(spark, [(i, "x y") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1])
    assert kneser_ney.digest(docs(spark, [])).count() == 0


def test_word_hashes_follow_words_only():
    a, _ = tokens.word_hashes("Ab  c\tÉd ab".encode())
    b, _ = tokens.word_hashes("aB c Éd AB".encode())
    assert (a == b).all() and a[0] == a[3] and len(set(a.tolist())) == 3


def test_texts_longer_than_a_chunk(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 50)
    texts = [b"aa bb cc", b"", b"word " * 60, b"q", b"y" * 200, b"zz " * 30 + b"e"]
    got = dict(tokens.documents(texts))
    for i, t in enumerate(texts):
        want = [int(tokens.word_hashes(w)[0][0]) for w in t.split()]
        assert got.get(i, np.empty(0)).tolist() == want
