"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. Every vector is represented by
its ``length`` nearest pivots in order; its block posts it, with the place, in
the inverted file of each of them. A query reads the files of its own nearest
pivots. Its footrule distance to a vector, the sum of the differences of the
pivots' places (a pivot that is missing stands one place past the end), is

    length * (length + 1) - 2 * sum over shared pivots of min(a, b)

where a and b count places from the end (last: 1). So the files of the shared
pivots are all it takes. The ``budget`` share of a block with the smallest
distances (equal ones by vec_id) is reranked by the exact inner product in
double precision.

Equal vectors are one entry of the index, under their smallest id: copies
neither fill the budget nor are searched for one by one. The entry carries its
k + 1 smallest ids; more of them can't be among the k best, as equal scores go
to the smaller id. The k + 1 best entries of a query vector give the rows, for
each id that asks for this vector without itself.

Queries and rows meet in blocks (see ``vectors.cells``); a cell hands on at
most k + 1 rows per query vector. The pivot sample is the only thing of bounded
size; every vector is indexed and each block is searched in full, small ones
like large ones. Nothing depends on the order of the rows.

Defined cases: see ``vectors.usable`` for vectors and ids that take no part;
zero vectors take none either; vectors are compared with those of their own
dimension only (pivots of the most common one; other dimensions are searched
exactly); equal scores go to the smaller id; fewer than k candidates give as
many rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import map_batches
from quarry.llm.common import written
from quarry.llm.vectors import best, cells, is_query, matrix, ranked, usable

K, EVERY = 20, 20
PIVOTS = 256  #: size of the sample
LENGTH = 48  #: nearest pivots kept of each vector
BUDGET = 0.25  #: share of a block that is reranked


def pick_pivots(vectors: DataFrame, pivots: int) -> np.ndarray:
    """Unit vectors of at most ``pivots`` rows of the most common dimension,
    those with the lowest hashes of their ids; equal ones once."""
    common = vectors.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(1).select(F.col("dim").alias("_d"))
    sample = (
        vectors.join(F.broadcast(common), F.col("dim") == F.col("_d"))  # one row
        .orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v").collect()
    )
    x = np.array([r["v"] for r in sample], np.float64)
    if not len(x):
        return np.empty((0, 0))
    return np.unique(x / np.linalg.norm(x, axis=1, keepdims=True), axis=0)


def permutations(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


def index(vectors: DataFrame, pivots: np.ndarray, length: int) -> DataFrame:
    """``vectors`` with the column ``near``: the ordered nearest pivots
    (empty for dimensions that have no pivots)."""

    def run(batches) -> Iterator[dict]:
        for b in batches:
            dims, near = b.column(2).to_numpy(), [[]] * b.num_rows
            mine = np.flatnonzero(dims == pivots.shape[1])
            if len(mine):
                x = matrix(pa.Table.from_batches([b.take(pa.array(mine))]), "v", np.float64)
                for i, p in zip(mine, permutations(x, pivots, length)):
                    near[i] = p
            yield {"vec_id": b.column(0), "v": b.column(1), "dim": b.column(2), "near": near}

    return map_batches(vectors.select("vec_id", "v", "dim"), run, "vec_id long, v array<double>, dim int, near array<smallint>")


def _post(near: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverted files: rows and places (from the end) by pivot, with bounds."""
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    row, place = order // near.shape[1], near.shape[1] - order % near.shape[1]
    return row, place.astype(np.int16), np.searchsorted(flat[order], np.arange(pivots + 1))


def _search(pivots: int, k: int, budget: float):
    def run(a: pa.Table, b: pa.Table) -> dict:
        b = b.sort_by("vec_id")
        q, x = matrix(a, "v", np.float64), matrix(b, "v", np.float64)
        ids, rows = a.column("vec_id").to_numpy(), b.column("vec_id").to_numpy()
        size = max(k, int(np.ceil(budget * len(rows))))
        near = matrix(b, "near", np.int64)
        exact = size >= len(rows) or near.shape[1] == 0
        if not exact:
            file_row, file_place, bound = _post(near, pivots)
            asked, length = matrix(a, "near", np.int64), near.shape[1]
        out = []
        for i in range(len(ids)):
            if exact:
                near_rows = np.arange(len(rows))
            else:
                shared = np.zeros(len(rows), np.int16)
                for place, p in enumerate(asked[i]):
                    part = slice(bound[p], bound[p + 1])
                    shared[file_row[part]] += np.minimum(file_place[part], length - place)
                # The smallest distances, equal ones by place, which is by vec_id.
                edge = np.partition(shared, len(rows) - size)[len(rows) - size]
                ahead, tied = np.flatnonzero(shared > edge), np.flatnonzero(shared == edge)
                near_rows = np.concatenate([ahead, tied[: size - len(ahead)]])
            score = x[near_rows] @ q[i]
            keep = best(np.zeros(len(score), np.int8), rows[near_rows], score, k)
            out.append((np.full(len(keep), ids[i]), rows[near_rows[keep]], score[keep]))
        return dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out))))

    return run


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, v, dim, members): the different vectors of (vec_id, v, dim),
    each with its ``k`` smallest ids; the ranks are cut before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k)
    members = F.array_sort(F.collect_list("vec_id"))
    return few.groupBy("v").agg(members.alias("members")).select(
        F.col("members")[0].alias("vec_id"), "v", F.size("v").alias("dim"), "members"
    )


def search(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY,
    pivots: int = PIVOTS, length: int = LENGTH, budget: float = BUDGET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found (highest
    inner product) for every row whose id is divisible by ``every``."""
    whole = usable(vectors, key, vector).where(F.exists("v", lambda c: c != 0))
    rows = written(whole, "permutation-vectors")
    known = written(entries(rows, k + 1), "permutation-entries")
    asking = rows.where(is_query(F.col("vec_id"), every)).select(F.col("vec_id").alias("asker"), F.col("v").alias("asked"))
    asking = written(
        asking.join(known, F.col("asked") == F.col("v")).select("asker", F.col("vec_id").alias("entry")), "permutation-asking"
    )
    chosen = pick_pivots(known, pivots)
    indexed = written(index(known, chosen, min(length, len(chosen))), "permutation-index")
    queries = written(
        indexed.join(asking.select("entry").distinct(), F.col("vec_id") == F.col("entry"), "left_semi"), "permutation-queries"
    )
    found = cells(
        queries, indexed, queries.count(), indexed.count(), _search(len(chosen), k + 1, budget), "query_id long, vec_id long, score double"
    )
    near = ranked(found, k + 1).select("query_id", F.col("vec_id").alias("entry"), "score")
    members = known.select(F.col("vec_id").alias("of"), "members")
    ids = near.join(members, F.col("entry") == F.col("of")).select("query_id", F.explode("members").alias("vec_id"), "score")
    best_ids = ranked(ids, k + 1).select(F.col("query_id").alias("of"), "vec_id", "score")
    each = written(best_ids, "permutation-found").join(asking, F.col("of") == F.col("entry")).where(F.col("asker") != F.col("vec_id"))
    return ranked(each.select(F.col("asker").alias("query_id"), "vec_id", "score"), k)


def digest(vectors: DataFrame) -> DataFrame:
    return search(vectors)
