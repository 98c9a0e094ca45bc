"""Running streaming queries to completion into durable sinks.

``run_available`` processes everything currently available
(``availableNow``) and returns when done; checkpoints and outputs live under
the shared checkpoint directory so a restarted driver resumes the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.session import delete_path, scratch_path


def _start(writer, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(
    stream: DataFrame,
    output_mode: str,
    sink_path: str | None = None,
    checkpoint: str | None = None,
    query_name: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Start ``stream`` and wait until all available input is processed.

    Sink choice:
    * ``foreach_batch`` -- user callback per micro-batch;
    * ``sink_path`` with ``complete`` -- each batch writes the full result to
      a folder of its own, ``batch=<id>`` (idempotent on retry), and then the
      versions before the last one go: a crash in the middle of a batch leaves
      the last whole result, which :func:`read_latest` finds;
    * ``sink_path`` with ``append`` -- Parquet file sink (exactly once);
    * otherwise a named in-memory table (small results, tests).
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif sink_path is not None and output_mode == "complete":
        def keep_version(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
            for old in _versions(spark, sink_path):
                if old < batch_id - 1:
                    delete_path(spark, f"{sink_path}/batch={old}")

        w = w.foreachBatch(keep_version)
    elif sink_path is not None:
        if output_mode != "append":
            raise ValueError(
                f"a Parquet sink takes append or complete output, not {output_mode!r}; "
                "use foreach_batch (e.g. a merge) or a memory sink"
            )
        w = w.format("parquet").option("path", sink_path)
    else:
        if not query_name:
            raise ValueError("a memory sink needs a query_name")
        w = w.format("memory")
    q = _start(w, available_now)
    if available_now:
        q.awaitTermination(timeout_s)
    else:
        q.processAllAvailable()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    return q


def start_append(stream: DataFrame, sink_path: str, checkpoint: str | None = None) -> StreamingQuery:
    """A running append query into a Parquet sink; the caller feeds its source,
    waits with ``processAllAvailable`` and stops it."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-ckpt")
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.format("parquet").option("path", sink_path).start()


def start_update(
    stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str | None = None
) -> StreamingQuery:
    """A running update query into a ``foreachBatch`` function, such as that of
    an upsert table; the caller feeds its source and stops it."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-ckpt")
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(take).start()


def read_sink(spark: SparkSession, sink_path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(sink_path)


def _versions(spark: SparkSession, sink_path: str) -> list[int]:
    """Batches whose complete result was written to the end."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{sink_path}/batch=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def read_latest(spark: SparkSession, sink_path: str) -> DataFrame:
    """The last whole result of a complete-mode sink."""
    versions = _versions(spark, sink_path)
    if not versions:
        raise ValueError(f"no batch has been written to {sink_path}")
    return spark.read.parquet(f"{sink_path}/batch={versions[-1]}")


def result_table(spark: SparkSession, name: str, sink_path: str) -> DataFrame:
    """The last whole result as a catalog table ``name`` (its files stay where
    they are), so that SQL can name it."""
    versions = _versions(spark, sink_path)
    spark.catalog.createTable(name, path=f"{sink_path}/batch={versions[-1]}", source="parquet")
    return spark.table(name)
