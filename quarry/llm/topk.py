"""Exact top-k search by a three-phase uniform threshold.

The components are cut into ``nodes`` parts; a node's score of a row is the
inner product over its part, and a row's score is the sum over the nodes.

1. Every node gives its local list, the k highest partial scores; the rows on
   these lists get their sums. The k-th highest sum of a query over all cells
   is its cutoff: at least k rows reach it, so no result is below.
2. The cutoff goes out with the queries. A row that reaches it has at least
   cutoff / nodes on some node: every node gives the entries that do.
3. The remaining partial scores of these entries are resolved exactly and the
   sums at or above the cutoff compete for the k places.

The nodes are slices of the components inside one task, not places of their
own. Phases 1 and 2 each compute every partial product of a cell, so the
cutoff spares no products, only entries that are gathered and sorted.

Queries and rows meet in blocks (see ``vectors.cells``). A cell hands on at
most k rows per query, with ties to the smaller id, which loses nothing.

Defined cases: see ``vectors.usable`` for vectors and ids that take no part;
vectors are compared with those of their own dimension only; equal scores go
to the smaller id; fewer than k candidates give as many rows; an empty table
gives an empty result; further columns are not read. Components whose sums
would leave 64 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.llm.vectors import best, cells, matrix, prepared, ranked, usable

K, EVERY, NODES, SCALE = 20, 20, 2, 64


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest type in which all sums of products are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top >= 2.0**63:
        raise OverflowError("inner products do not fit in 64 bits")
    return np.float32 if top < 2.0**24 else np.float64 if top < 2.0**53 else np.int64


def _partial(a: pa.Table, b: pa.Table, nodes: int) -> list[np.ndarray]:
    """The nodes' scores, queries by rows; a query never meets itself (its
    scores with its own row are set below all others by the callers)."""
    q, x = matrix(a, "v", np.int64), matrix(b, "v", np.int64)
    kind = _exact(q, x)
    q, x = q.astype(kind), x.astype(kind)
    cuts = np.array_split(np.arange(q.shape[1]), min(nodes, q.shape[1]))
    return [q[:, c] @ x[:, c].T for c in cuts]


def _self(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions where query and row are the same."""
    ids, rows = a.column("vec_id").to_numpy(), b.column("vec_id").to_numpy()
    order = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows[order], ids), len(rows) - 1)
    hit = np.flatnonzero(rows[order[at]] == ids)
    return hit, order[at[hit]]


def _lists(k: int, nodes: int):
    def run(a: pa.Table, b: pa.Table) -> dict:
        parts = _partial(a, b, nodes)
        total, own = sum(p.astype(np.float64) if p.dtype != np.int64 else p for p in parts), _self(a, b)
        n, m = total.shape
        listed = np.zeros(total.shape, bool)
        for p in parts:
            if m > k + 1:  # one place more, as the query itself may be on it
                np.put_along_axis(listed, np.argpartition(-p, k, axis=1)[:, : k + 1], True, axis=1)
            else:
                listed[:] = True
        listed[own] = False
        qi, xi = np.nonzero(listed)
        score = total[qi, xi].astype(np.int64)
        keep = best(qi, xi, score, k)
        return {"query_id": a.column("vec_id").to_numpy()[qi[keep]], "score": score[keep]}

    return run


def _entries(k: int, nodes: int):
    def run(a: pa.Table, b: pa.Table) -> dict:
        parts = _partial(a, b, nodes)
        # No cutoff: fewer than k candidates in all, and every row is needed.
        low = a.column("cutoff").to_numpy(zero_copy_only=False).astype(np.float64)
        low = np.where(np.isnan(low), -np.inf, low)
        own = _self(a, b)
        enough = np.zeros(parts[0].shape, bool)
        for p in parts:
            enough |= p >= (low / len(parts))[:, None]
        enough[own] = False
        qi, xi = np.nonzero(enough)
        score = sum(p[qi, xi].astype(np.int64) for p in parts)
        keep = score >= low[qi]
        qi, xi, score = qi[keep], xi[keep], score[keep]
        vec = b.column("vec_id").to_numpy()[xi]
        keep = best(qi, vec, score, k)
        return {"query_id": a.column("vec_id").to_numpy()[qi[keep]], "vec_id": vec[keep], "score": score[keep]}

    return run


def search(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
    every: int = EVERY, nodes: int = NODES, scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner
    product for every row whose id is divisible by ``every``."""
    whole = usable(vectors, key, vector).select(
        "vec_id", "dim", F.transform("v", lambda x: F.floor(x * scale)).alias("v")
    )
    rows, queries, nq, n = prepared(whole, every, "topk-rows")
    lists = cells(queries, rows, nq, n, _lists(k, nodes), "query_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc()))
    cutoffs = written(
        lists.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k)
        .select(F.col("query_id").alias("_id"), F.col("score").alias("cutoff")),
        "topk-cutoffs",
    )
    asked = queries.join(cutoffs, F.col("vec_id") == F.col("_id"), "left").drop("_id")
    found = cells(asked, rows, nq, n, _entries(k, nodes), "query_id long, vec_id long, score long")
    return ranked(found, k)


def digest(vectors: DataFrame) -> DataFrame:
    return search(vectors)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         list_dot_product(q.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0),
numbered AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM pairs)
SELECT * FROM numbered WHERE rank <= 20
"""
