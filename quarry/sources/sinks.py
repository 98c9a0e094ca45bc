"""Batch sinks: partitioned Parquet and n-file writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    mode: str = "errorifexists",
    fmt: str = "parquet",
) -> str:
    """Write ``df`` partitioned by ``partition_cols`` (one directory per value).

    Default mode fails if the target exists, like a bare ``write.parquet``.
    Rows are clustered on the partition columns with a REBALANCE hint so each
    task writes few directories; unlike ``repartition(cols)``, AQE splits a
    value that holds a large share of the rows over several tasks/files.
    """
    cols = list(partition_cols)
    (
        df.hint("rebalance", *cols)
        .write.mode(mode)
        .partitionBy(*cols)
        .format(fmt)
        .save(path)
    )
    return path


def write_n_files(
    df: DataFrame,
    path: str,
    n_files: int = 20,
    fmt: str = "parquet",
    mode: str = "overwrite",
    header: bool = False,
    keys: Sequence[str] = (),
    max_rows: int = 5_000_000,
) -> str:
    """Spread ``df`` over at least ``n_files`` files and write.

    An input that has more partitions than that keeps as many tasks, and no
    file gets more than ``max_rows`` rows, so a large table does not go
    through ``n_files`` tasks. With ``keys`` a row's file follows from a hash
    of them and not from the order of the input. Used to stage a table as a
    sequence of files for a file-stream source.
    """
    tasks = max(n_files, df.rdd.getNumPartitions())
    writer = df.repartition(tasks, *keys).write.mode(mode).format(fmt).option("maxRecordsPerFile", max_rows)
    if fmt == "csv":
        writer = writer.option("header", str(header).lower())
    writer.save(path)
    return path
