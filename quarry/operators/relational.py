"""Relational operators: counts, group averages (DataFrame and SQL forms),
de-duplication, joins through a link table, top-n, null handling.

All operators take and return DataFrames; actions are left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(df: DataFrame, condition: Column, alias: str = "n") -> DataFrame:
    """Rows matching ``condition`` as a one-row DataFrame (partial counts per
    task, one tiny final merge)."""
    return df.filter(condition).agg(F.count(F.lit(1)).alias(alias))


def count_where_sql(
    df: DataFrame, column: str, value, alias: str = "n"
) -> DataFrame:
    """SQL twin of :func:`count_where` for an equality predicate.

    The value is bound as a named parameter, never pasted into the text.
    """
    return df.sparkSession.sql(
        f"SELECT COUNT(*) AS {alias} FROM {{rows}} WHERE `{column}` = :value",
        args={"value": value},
        rows=df,  # a view that is dropped once the query is analysed
    )


def avg_by_group(
    df: DataFrame,
    key: str,
    value: str,
    alias: str = "avg_value",
    digits: int | None = None,
) -> DataFrame:
    """Average of ``value`` per ``key``, highest first, key as tie-break."""
    avg = F.avg(value)
    if digits is not None:
        avg = F.round(avg, digits)
    return (
        df.groupBy(key)
        .agg(avg.alias(alias))
        .orderBy(F.col(alias).desc(), F.col(key).asc())
    )


def avg_by_group_sql(
    df: DataFrame,
    key: str,
    value: str,
    alias: str = "avg_value",
    digits: int | None = None,
) -> DataFrame:
    """SQL twin of :func:`avg_by_group`."""
    expr = f"AVG(`{value}`)"
    if digits is not None:
        expr = f"ROUND({expr}, {int(digits)})"
    return df.sparkSession.sql(
        f"SELECT `{key}`, {expr} AS {alias} FROM {{rows}} "
        f"GROUP BY `{key}` ORDER BY {alias} DESC, `{key}` ASC",
        rows=df,
    )


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of ``df`` (or of a projection); partial de-dup happens
    map-side before the shuffle, so a hot value costs one row per task."""
    return (df.select(*cols) if cols else df).distinct()


def link_join(
    link: DataFrame,
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    distinct: bool = True,
) -> DataFrame:
    """Inner USING join of a link table to two dimensions:
    ``link JOIN left USING (left_key) JOIN right USING (right_key)``.

    With ``distinct`` the three inputs are de-duplicated before the joins.
    All their columns are kept, so the joined rows are then distinct by
    themselves and the wide result is never shuffled for it. The physical
    strategy (broadcast when a side is small at run time, else sort-merge
    with skew splitting) is left to AQE.
    """
    if distinct:
        link, left, right = link.distinct(), left.distinct(), right.distinct()
    return link.join(left, left_key).join(right, right_key)


def top_n(
    df: DataFrame, n: int, order: Sequence[Column | str]
) -> DataFrame:
    """First ``n`` rows under a total order (TakeOrderedAndProject: each task
    keeps its own n best, the driver merges n x tasks rows)."""
    return df.orderBy(*order).limit(n)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null in any column (or in ``subset``)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def row_loss(
    df: DataFrame, subset: Sequence[str] | None = None, digits: int = 6
) -> DataFrame:
    """Row counts before / after dropping incomplete rows and the loss in
    percent, from a single pass over ``df``."""
    cols = list(subset) if subset else df.columns
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(f"`{c}`").isNotNull()
    out = df.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count(F.when(complete, 1)).alias("n_after"),
    )
    return out.withColumn(
        "loss_pct",
        F.round(
            F.try_divide(F.col("n_before") - F.col("n_after"), F.col("n_before")) * 100.0,
            digits,
        ),
    )


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL UNION: positional union of all inputs, then distinct."""
    out = dfs[0]
    for other in dfs[1:]:
        out = out.union(other)
    return out.distinct()
