"""Session construction and shared-storage helpers.

Everything that writes intermediate data (iterative loops, round trips,
stream sinks) goes under the checkpoint directory the cluster names in
``spark.checkpoint.dir``. Only where that setting is missing *and* the session
runs in local mode is a private directory made, with a warning, and removed at
exit. Intermediate data lies in one folder per application, which
:func:`clear_scratch` deletes once its results are no longer needed.
"""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants. Sizes are per-cluster knobs:
# shuffle partitions default to a multiple of the cores; AQE then coalesces
# small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Broadcast bounds, stated rather than implied: the static planner only
    # broadcasts a side whose estimated size is under 10 MB, AQE only one
    # whose measured shuffle output is.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared directory for checkpoints and intermediate tables.

    Order: the session's ``spark.checkpoint.dir``; else the directory already
    on the context; else (local mode only) a fresh private folder. On a
    cluster without the setting this raises instead of using a machine-local
    path that executors cannot share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running iterative or streaming operators"
        )
    private = tempfile.mkdtemp(prefix="quarry-ckpt-")
    atexit.register(shutil.rmtree, private, ignore_errors=True)
    warnings.warn(f"spark.checkpoint.dir is not set: using {private} until exit", stacklevel=2)
    sc.setCheckpointDir(private)
    return sc.getCheckpointDir() or private


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-scratch/{app_id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the application's folder under the shared
    checkpoint directory."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def app_path(spark: SparkSession, name: str) -> str:
    """A fixed path in the application's folder under the shared checkpoint
    directory, for what several queries of one application share."""
    return f"{_scratch_root(spark)}/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, pattern: str, up: int = 0) -> list[str]:
    """Names of the paths that match a glob, of any file system that Spark
    knows; with ``up`` the names of their parents that many levels above."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = []
    for status in found or []:
        at = status.getPath()
        for _ in range(up):
            at = at.getParent()
        names.append(at.getName())
    return names


def data_digest(df: DataFrame) -> str:
    """A digest of the plan of ``df`` and of the files it reads, with their
    sizes and times: equal for the same query over unchanged files."""
    spark = df.sparkSession
    files = []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((df.semanticHash(), files)).encode()).hexdigest()


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. DataFrames that operators
    returned read from them, so call it when those are no longer needed."""
    delete_path(spark, _scratch_root(spark))


def cut_lineage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint directory
    and return it read back: computed once, plan truncated, and durable if
    an executor is lost. (A reliable ``checkpoint()`` of an uncached frame
    would compute it twice: once to count, once to write.)"""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query go when it has ended, not when the
    driver happens to collect its garbage. For loops that write a step, read it
    back and never run the same frame twice."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
