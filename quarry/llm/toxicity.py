"""Toxicity: a linear classifier on character n-grams with naive Bayes scales.

Features are the character n-grams of the lower-cased text (set per document,
hashed to ``1 << BITS`` buckets). Training: document counts per class give
every feature its smoothed log-count ratio; the features that tell most are
kept, each worth its ratio, and a logistic regression is fitted on them.
Scoring is one pass over the texts: a dense table of ratio times weight, looked
up for every n-gram, summed over a document's different features.

The fit reads a bounded sample of the labelled rows: at most ``max_rows`` ids
(lowest hashes of doc_id) and one row of each, so neither many labels nor an id
that many rows share makes it larger. It keeps ``max_features`` features, so
model and sample have the same size at any corpus size; every text is scored
whole.

Defined cases: null and empty texts get the score of a text without features;
rows without label, or with null labels or ids, are not learnt from; a doc_id
with several labels counts as its highest, one with several rows is learnt
from once (the row whose text has the lowest hash); equal rows get equal
scores, ties at the threshold count as toxic; without labels of both classes
the score is the share of label 1 (0 if there are none); a null doc_id is not
held out; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import map_batches, texts
from quarry.llm.common import written

SIZES = (4, 5)  #: lengths of the n-grams
BITS = 22
CHUNK = 1 << 18  #: characters hashed at once
MAX_ROWS = 40_000
MAX_FEATURES = 2048
MIN_DOCS = 5  #: documents of the sample that a feature needs
SMOOTHING = 1.0
RIDGE = 3e-4
STEPS = 300
THRESHOLD = 0.3

_MUL = np.uint64(0x9E3779B97F4A7C15)  #: fixed value: 2^64 / golden ratio, odd


def ngram_buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """Buckets of all n-grams of an array of code points, in order."""
    if len(codes) < n:
        return np.empty(0, np.int64)
    m = len(codes) - n + 1
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h = (h ^ codes[j : j + m]) * _MUL
        h ^= h >> np.uint64(29)
    return ((h * _MUL) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str, keep: np.ndarray | None = None) -> np.ndarray:
    """The different buckets of a text, sorted; only those where ``keep`` is
    not 0, if given. Long texts go in chunks that overlap by n - 1."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    for at in range(0, len(codes), CHUNK):
        for n in SIZES:
            b = ngram_buckets(codes[at : at + CHUNK + n - 1], n)
            found.append(np.unique(b if keep is None else b[keep[b] != 0]))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    left = F.crc32(key.cast("string").cast("binary")) % parts
    return F.coalesce(left == part, F.lit(False))


def _count(batches) -> Iterator[dict]:
    """(bucket, toxic, docs): document counts of a task's rows."""
    size = 1 << BITS
    counts = [np.zeros(size, np.int32), np.zeros(size, np.int32)]
    for b in batches:
        for body, y in zip(texts(b.column(0)), b.column(1)):
            counts[y.as_py()][features(body)] += 1
    for y, c in enumerate(counts):
        at = np.flatnonzero(c)
        yield {"bucket": at.astype(np.int32), "toxic": np.full(len(at), y, np.int32), "docs": c[at].astype(np.int64)}


def _gather(ratio_at: np.ndarray):
    def run(batches) -> Iterator[dict]:
        keep = np.zeros(1 << BITS, bool)
        keep[ratio_at] = True
        for b in batches:
            rows = [features(body, keep).astype(np.int32) for body in texts(b.column(0))]
            yield {"buckets": [r.tobytes() for r in rows], "toxic": b.column(1)}

    return run


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on 0/1 features times ``scale``; rows hold
    column numbers. Full-batch gradient steps with momentum, in NumPy."""
    lengths = np.array([len(r) for r in rows])
    col = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    value = scale[col]
    w, b = np.zeros(len(scale)), float(np.log(y.mean() / (1 - y.mean())))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = b + np.bincount(row, weights=value * w[col], minlength=len(rows))
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.bincount(col, weights=value * err[row], minlength=len(w)) + RIDGE * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = 0.05 / (1 - 0.9**t)
        fix = 1 - 0.999**t
        w -= step * m / (np.sqrt(v / fix) + 1e-8)
        b -= step * mb / (np.sqrt(vb / fix) + 1e-8)
    return w, b


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
) -> dict:
    """The model: buckets, their weights (ratio times coefficient), bias."""
    sample = (
        labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("_k").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("_k")))
        .groupBy("_k").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("_k"), "_k").limit(max_rows)
    )
    # Broadcast: at most max_rows rows of (id, label). One row per id, whatever
    # the table repeats; written once, as the steps below read it three times.
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_id"), F.struct(F.xxhash64(body).alias("h"), body.alias("text")).alias("_text")).join(
        F.broadcast(sample), F.col("_id") == F.col("_k")
    )
    rows = written(
        rows.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("toxic").alias("toxic")).select("_text.text", "toxic"),
        "toxicity-sample",
    )
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    empty = {"at": np.empty(0, np.int64), "weight": np.empty(0, np.float32)}
    if not pos or not neg:
        return {**empty, "bias": 40.0 if pos else -40.0}
    counts = map_batches(rows, _count, "bucket int, toxic int, docs long").groupBy("bucket").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("q"),
    )
    ratio = F.log((F.col("p") + SMOOTHING) / (pos + 2 * SMOOTHING)) - F.log((F.col("q") + SMOOTHING) / (neg + 2 * SMOOTHING))
    told = F.abs(F.col("ratio")) * F.sqrt(F.col("p") + F.col("q"))
    best = (
        counts.where(F.col("p") + F.col("q") >= MIN_DOCS).withColumn("ratio", ratio)
        .orderBy(told.desc(), "bucket").limit(max_features).select("bucket", "ratio").collect()
    )
    at = np.array([r["bucket"] for r in best], np.int64)
    order = np.argsort(at)
    at, scale = at[order], np.array([r["ratio"] for r in best], np.float64)[order]
    gathered = map_batches(rows, _gather(at), "buckets binary, toxic int").collect()
    columns = [np.searchsorted(at, np.frombuffer(r["buckets"], np.int32)) for r in gathered]
    w, bias = fit_logistic(columns, np.array([r["toxic"] for r in gathered], np.float64), scale)
    return {"at": at, "weight": (w * scale).astype(np.float32), "bias": bias}


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    at, weight, bias = model["at"], model["weight"], model["bias"]

    def run(batches) -> Iterator[dict]:
        table = np.zeros(1 << BITS, np.float32)
        table[at] = weight
        for b in batches:
            z = np.array([bias + float(table[features(body, table)].sum(dtype=np.float64)) for body in texts(b.column(1))])
            yield {"doc_id": b.column(0), "score": 1 / (1 + np.exp(-np.clip(z, -40, 40)))}

    scored = map_batches(docs.select(key, text), run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; same columns,
    whatever their names. Null and empty texts, repeated rows and null ids are
    judged by their own score; an empty table stays empty."""
    names = docs.columns
    model = train(docs, labels, text=text)
    at, weight, bias = model["at"], model["weight"], model["bias"]

    def run(batches) -> Iterator:
        import pyarrow as pa

        table = np.zeros(1 << BITS, np.float32)
        table[at] = weight
        cut = np.log(threshold / (1 - threshold))
        for b in batches:
            z = np.array([bias + float(table[features(body, table)].sum(dtype=np.float64)) for body in texts(b.column(names.index(text)))])
            yield b.filter(pa.array(z < cut))

    return map_batches(docs, run, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
