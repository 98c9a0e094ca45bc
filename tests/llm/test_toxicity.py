import zlib

import numpy as np
import pytest

from quarry.llm import toxicity
from tests.llm.fixtures import AWKWARD, docs

LABELS = "doc_id long, quality int, toxic int, text string, score string"


def labels(spark, rows):
    return spark.createDataFrame([(i, 0, y, "t", "s") for i, y in rows], LABELS)


def features(text):
    t = f" {text.lower()} "
    return {t[i : i + n] for n in toxicity.SIZES for i in range(len(t) - n + 1)}


def test_buckets_are_those_of_the_ngrams(monkeypatch):
    one = lambda g: toxicity.ngram_buckets(np.array([ord(c) for c in g], np.uint64), len(g))[0]
    for text in ("abc", "Some Text é\U0001f600 with ab ab ab", ""):
        want = sorted({int(one(g)) for g in features(text)})
        for chunk in (1 << 20, 7):
            monkeypatch.setattr(toxicity, "CHUNK", chunk)
            assert toxicity.features(text).tolist() == want


def test_fit_matches_the_gradient_condition():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(20) < 0.3) for _ in range(400)]
    y = np.array([float((3 in r) != (rng.random() < 0.05)) for r in rows])
    scale = rng.normal(size=20)
    scale[3] = 2.0
    w, b = toxicity.fit_logistic(rows, y, scale)
    x = np.zeros((400, 20))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) / 400 + toxicity.RIDGE * w).max() < 0.02
    assert ((p >= 0.3) == (y == 1)).mean() > 0.9


def sample(n=400):
    rng = np.random.default_rng(3)
    words = ["river", "stone", "table", "green", "walk", "letter", "sound", "paper", "summer", "light"]
    rows, marks = [], []
    for i in range(n):
        body = list(rng.choice(words, 30))
        if i % 5 == 0:
            body[int(rng.integers(30))] = "nastyword"
        rows.append((i, " ".join(body)))
        marks.append((i, int(i % 5 == 0)))
    return rows, marks


def test_held_out_documents_are_told_apart(spark):
    rows, marks = sample()
    out = {r["doc_id"]: r for r in toxicity.digest(docs(spark, [*rows, *AWKWARD]), labels(spark, marks)).collect() if r["doc_id"] is not None}
    for i, y in marks:
        if i > 10:
            assert out[i]["predicted"] == y and 0 <= out[i]["score"] <= 1
            assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_held_out_labels_are_never_read(spark):
    rows, marks = sample()
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in marks]
    df = docs(spark, rows)
    a, b = (sorted(toxicity.digest(df, labels(spark, m)).collect()) for m in (marks, turned))
    assert a == b


def test_awkward_labels_and_empty_tables(spark):
    rows, marks = sample(100)
    odd = [*marks, (None, 1), (3, None), (1, 1), (1, 0), (99999, 1)]
    assert toxicity.digest(docs(spark, rows), labels(spark, odd)).count() == 100
    assert toxicity.digest(docs(spark, []), labels(spark, marks)).count() == 0
    assert {r["predicted"] for r in toxicity.digest(docs(spark, rows), labels(spark, [])).collect()} == {0}


def test_rejected_documents_go(spark):
    rows, marks = sample()
    df = docs(spark, rows)
    out = toxicity.keep_clean(df, labels(spark, marks))
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [i for i, y in marks if not y]


def test_accuracy_on_the_given_labels(spark):
    d, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.digest(d, marks).where("held_out").join(marks, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in out)
    assert hit >= 0.8 * sum(r["toxic"] for r in out)
    assert sum(r["predicted"] and not r["toxic"] for r in out) <= 0.02 * len(out)


def test_repeated_rows_teach_once(spark):
    """A third of all rows is one labelled row: scores are those without it."""
    rows, marks = sample()
    df, hot = docs(spark, rows), [rows[7]] * 200
    plain = {r["doc_id"]: r["score"] for r in toxicity.digest(df, labels(spark, marks)).collect()}
    got = toxicity.digest(docs(spark, [*rows, *hot]), labels(spark, marks)).collect()
    assert len(got) == len(rows) + 200
    assert all(r["score"] == pytest.approx(plain[r["doc_id"]], abs=1e-9) for r in got)


def test_scores_are_those_of_the_model(spark):
    """Counts, ratios, weights and scores again, from n-grams in plain Python."""
    rows, marks = sample(200)
    df, marked = docs(spark, rows), dict(marks)
    model = toxicity.train(df, labels(spark, marks))
    learnt = [(features(t), marked[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    totals = [sum(1 for _, y in learnt if y == k) for k in (0, 1)]
    seen = {}
    for grams, y in learnt:
        for b in {bucket(g) for g in grams}:
            seen.setdefault(b, [0, 0])[y] += 1
    ratio = {b: np.log((p + 1) / (totals[1] + 2)) - np.log((q + 1) / (totals[0] + 2)) for b, (q, p) in seen.items()}
    told = sorted((-abs(ratio[b]) * (sum(seen[b]) ** 0.5), b) for b in seen if sum(seen[b]) >= toxicity.MIN_DOCS)
    best = {b for _, b in told[: toxicity.MAX_FEATURES]}
    # Equal values at the cut may go either way.
    cut = -told[min(len(told), toxicity.MAX_FEATURES) - 1][0]
    assert all(b in set(model["at"].tolist()) for b in best if abs(ratio[b]) * (sum(seen[b]) ** 0.5) > cut + 1e-9)
    weight = dict(zip(model["at"].tolist(), model["weight"].tolist()))
    for r in toxicity.score(df, model).collect():
        body = dict(rows)[r["doc_id"]]
        z = model["bias"] + sum(weight.get(b, 0.0) for b in {bucket(g) for g in features(body)})
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)
        assert r["predicted"] == int(r["score"] >= 0.3)


def bucket(gram):
    return int(toxicity.ngram_buckets(np.array([ord(c) for c in gram], np.uint64), len(gram))[0])
