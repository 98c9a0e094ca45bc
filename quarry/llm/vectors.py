"""Vectors in blocks: a stated query set against all rows, cell by cell."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import _arrow, batch, give_back
from quarry.llm.common import written

ROWS, QUERIES = 8192, 1024  #: about so many rows and queries meet in a cell


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, dim, v array<double>): one row per non-null id. Vectors that
    are null, empty or hold null or non-finite components are left out; of
    different vectors under one id the smallest (component by component)
    stays."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vector).cast("array<double>")
    return (
        df.select(F.col(key).alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )


def is_query(key: Column, every: int) -> Column:
    return key % every == 0


def cells(
    queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int,
    func: Callable[[pa.Table, pa.Table], dict], schema: str,
) -> DataFrame:
    """Runs ``func(queries, rows)`` for every pair of a query block and a row
    block of one dimension. Blocks are dealt by a hash of vec_id, which is
    unique, so they are even; each block goes to the cells it belongs to."""
    qs, rs = -(-max(n_queries, 1) // QUERIES), -(-max(n_rows, 1) // ROWS)
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.toDF(*queries.columns).withColumn("_q", part(qs)).withColumn("_r", spread(rs))
    right = rows.toDF(*rows.columns).withColumn("_r", part(rs)).withColumn("_q", spread(qs))
    fields = _arrow(schema)
    empty = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in fields], schema=fields)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = batch(func(a, b), fields) if a.num_rows and b.num_rows else empty
        give_back()
        return pa.Table.from_batches([out])

    keys = ("dim", "_q", "_r")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def matrix(t: pa.Table, column: str, dtype) -> np.ndarray:
    c = t.column(column).combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(t.num_rows, -1)


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of every query's k highest scores, ties to the smaller id."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, int)
    length = np.diff(np.append(first, len(q)))
    return order[np.arange(len(q)) - np.repeat(first, length) < k]


def ranked(df: DataFrame, k: int) -> DataFrame:
    """The k best of all cells: (query_id, rank, vec_id, score)."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return df.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def prepared(df: DataFrame, every: int, name: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Rows written once, the queries among them, and both counts."""
    rows = written(df, name)
    queries = rows.where(is_query(F.col("vec_id"), every))
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query(F.col("vec_id"), every), 1)).alias("q")).first()
    return rows, queries, n["q"], n["n"]
