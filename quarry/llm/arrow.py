"""Small helpers for operators that run NumPy on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# The functions go to the workers with their code: executors need not have
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules["quarry.llm"])


def map_batches(
    df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` whose function may yield dicts of columns."""
    fields = _arrow(schema)

    def run(batches):
        try:
            for out in func(batches):
                yield out if isinstance(out, pa.RecordBatch) else batch(out, fields)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return free memory to the system: workers are reused and would hold the
    peak of one task through all tasks and stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def apply_groups(df: DataFrame, keys: list[str], func: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """``applyInArrow`` whose function returns a dict of columns."""
    fields = _arrow(schema)

    def run(t: pa.Table) -> pa.Table:
        out = pa.Table.from_batches([batch(func(t), fields)])
        give_back()
        return out

    return df.groupBy(*keys).applyInArrow(run, schema)


def batch(columns: dict, fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type, from_pandas=False)
         for f, c in ((f, columns[f.name]) for f in fields)],
        schema=fields,
    )


def _arrow(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    parsed = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)


def texts(column: pa.Array) -> Iterable[str]:
    """The texts of a column, one by one (null: empty)."""
    for value in column:
        yield value.as_py() or ""
