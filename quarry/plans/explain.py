"""Plan inspection for tests and tuning: the text of ``explain`` and a few
checks on it (pruned partitions, no cartesian products, no Python UDFs)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

CROSS_MARKERS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON_MARKERS = ("BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def has_cross_product(df: DataFrame) -> bool:
    text = plan_text(df, "extended")
    return any(m in text for m in CROSS_MARKERS)


def has_python_eval(df: DataFrame) -> bool:
    text = plan_text(df, "extended")
    return any(m in text for m in PYTHON_MARKERS)


def partition_filters(df: DataFrame) -> list[str]:
    return [
        line.strip()
        for line in plan_text(df, "formatted").splitlines()
        if "PartitionFilters: [" in line and "PartitionFilters: []" not in line
    ]
