"""Catalogue entries for the streaming jobs.

Each runs a file-stream query to completion (``availableNow``) with its
checkpoint and sink under the shared checkpoint directory, then returns the
sink read back as a batch DataFrame.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.ml.split import hash_split
from quarry.operators.trends import flatten_window
from quarry.plans.tables import TREND_MIN_COUNT, tagged_events
from quarry.ml.store import load_model
from quarry.plans.tables_ml import (
    SPLIT_SEED, TRAIN_FRACTION, TREE_SQL, fit_forest, fit_tree, retail_frame, tree_frame,
)
from quarry.session import scratch_path
from quarry.sources.parquet import read_table
from quarry.sources.sinks import write_n_files, write_partitioned
from quarry.streaming.scoring import confusion_per_batch, metrics_per_batch
from quarry.streaming.sinks import read_sink, result_table, run_available, start_append, start_update
from quarry.streaming.sources import csv_stream, parquet_stream
from quarry.streaming.trends import trending_tags_stream
from quarry.streaming.upsert import upsert_sink

# Fixed parameters of the streaming catalogue.
WINDOW = "60 minutes"
SLIDE = "30 minutes"
WATERMARK = "24 hours"
BLOCK_SECONDS = 5 * 86400
LATE_BLOCKS = 2
STREAM_FILES = 20
FILES_PER_TRIGGER = 5
METRIC_DIGITS = 9


def _tag_stream(stream: DataFrame) -> DataFrame:
    """The tag derivation of ``tagged_events`` applied to a stream."""
    tags = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(",", F.col("event_type"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")))
    )
    return stream.select("event_id", "ts", tags.alias("tag"))


TAG_SCHEMA = "event_id long, ts timestamp, tag string"


def stream_trending_tags(spark, sf_dir):
    """The reference's route: the tagged events are staged as 20 headerless
    CSV files, streamed back with a fixed schema five files per batch,
    counted in complete mode, and the result table is queried with SQL."""
    staged = tagged_events(spark, sf_dir).withColumnRenamed("tags", "tag")
    src_dir = scratch_path(spark, "tags-csv")
    write_n_files(staged, src_dir, n_files=STREAM_FILES, fmt="csv")
    src = csv_stream(spark, src_dir, TAG_SCHEMA, max_files_per_trigger=FILES_PER_TRIGGER)
    trend = trending_tags_stream(
        src, "ts", "tag", TREND_MIN_COUNT, WINDOW, SLIDE, WATERMARK, "tag_count"
    )
    out = scratch_path(spark, "trending-tags")
    run_available(trend, "complete", sink_path=out)
    table = f"trending_tags_{uuid.uuid4().hex}"
    flat = flatten_window(result_table(spark, table, out))
    try:
        return spark.sql(
            "SELECT window_start, window_end, tag, tag_count FROM {flat} "
            "ORDER BY window_start, tag_count DESC, tag",
            flat=flat,
        )
    finally:
        spark.sql(f"DROP TABLE {table}")  # the result's files stay


def staged_events(spark, sf_dir) -> DataFrame:
    """Events with the block they arrive in: blocks of five days of event
    time; every tenth event (id ending in 3) arrives two blocks late."""
    ev = read_table(spark, sf_dir, "events")
    block = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / BLOCK_SECONDS)
    late = F.col("event_id") % 10 == 3
    return ev.withColumn(
        "arrival", F.when(late, block + LATE_BLOCKS).otherwise(block).cast("long")
    )


def stream_late_data(spark, sf_dir):
    """Append-mode trend counts over a stream whose blocks arrive in order.

    The events are staged once, partitioned by arrival block (one scan of the
    table). One query runs over the source directory; each block is put there
    with a partition-pruned read once the block before it has been processed,
    so the watermark that moved between blocks drops the late rows.
    """
    staged = staged_events(spark, sf_dir)
    schema = staged.drop("arrival").schema
    stage_dir = scratch_path(spark, "late-stage")
    write_partitioned(staged, stage_dir, ["arrival"])
    stage = spark.read.schema(staged.schema).parquet(stage_dir)
    first, last = stage.agg(F.min("arrival"), F.max("arrival")).first()
    src_dir = scratch_path(spark, "late-src")
    out = scratch_path(spark, "late-out")
    stage.limit(0).drop("arrival").write.parquet(src_dir)
    trend = trending_tags_stream(
        _tag_stream(parquet_stream(spark, src_dir, schema)), "ts", "tag", 0, WINDOW, SLIDE, WATERMARK, "tag_count"
    )
    query = start_append(trend, out)
    try:
        for block in range(first, last + 1) if first is not None else ():
            stage.filter(F.col("arrival") == block).drop("arrival").write.mode("append").parquet(src_dir)
            query.processAllAvailable()
    finally:
        query.stop()
    res = flatten_window(read_sink(spark, out, trend.schema))
    return res.select("window_start", "window_end", "tag", "tag_count")


def stream_updates(spark, sf_dir):
    """Update-mode trend counts upserted into a table: the events arrive in
    blocks of event time, each batch emits the (window, tag) counts that
    changed, and the table holds the last one of each."""
    events = staged_events(spark, sf_dir)
    on_time = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / BLOCK_SECONDS).cast("long")
    stage_dir, src_dir = scratch_path(spark, "update-stage"), scratch_path(spark, "update-src")
    staged = events.withColumn("arrival", on_time)
    write_partitioned(staged, stage_dir, ["arrival"])
    stage = spark.read.schema(staged.schema).parquet(stage_dir)
    stage.limit(0).drop("arrival").write.parquet(src_dir)
    stream = _tag_stream(parquet_stream(spark, src_dir, staged.drop("arrival").schema))
    trend = trending_tags_stream(stream, "ts", "tag", TREND_MIN_COUNT, WINDOW, SLIDE, WATERMARK, "tag_count")
    keys = ["window_start", "window_end", "tag"]
    table, take = upsert_sink(
        spark, scratch_path(spark, "trend-table"), keys, flatten_window, flatten_window(trend).schema, compact_every=4
    )
    first, last = stage.agg(F.min("arrival"), F.max("arrival")).first()
    query = start_update(trend, take)
    try:
        for block in range(first, last + 1) if first is not None else ():
            stage.filter(F.col("arrival") == block).drop("arrival").write.mode("append").parquet(src_dir)
            query.processAllAvailable()
    finally:
        query.stop()
    return table.read()


def tree_stream(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The tree's test split and a stream of it, staged as 20 files."""
    data = tree_frame(spark, sf_dir)
    _, test = hash_split(data, ["id"], TRAIN_FRACTION, SPLIT_SEED)
    src_dir = scratch_path(spark, "tree-src")
    write_n_files(test, src_dir, n_files=STREAM_FILES, fmt="parquet", keys=["id"])
    return test, parquet_stream(spark, src_dir, data.schema, max_files_per_trigger=FILES_PER_TRIGGER)


def stream_tree_confusion(spark, sf_dir):
    """Every batch scored with a saved version of the two-level tree; the
    batches' confusion counts, summed."""
    _, version, root = fit_tree(spark, sf_dir)
    _, stream = tree_stream(spark, sf_dir)
    out = scratch_path(spark, "tree-confusion")
    run_available(stream, "append", foreach_batch=confusion_per_batch(load_model(spark, root, version), out, "label"))
    counts = spark.read.schema("label double, prediction double, n long").parquet(os.path.join(out, "batch_id=*"))
    return counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def stream_batch_metrics(spark, sf_dir):
    """Fit the forest on the training split, stage the test split as 20
    Parquet files by a hash of the key, stream them five files per batch and
    store the four metrics of every batch."""
    data = retail_frame(spark, sf_dir)
    _, test = hash_split(data, ["o_orderkey"], TRAIN_FRACTION, SPLIT_SEED)
    model = fit_forest(spark, sf_dir)
    src_dir = scratch_path(spark, "score-src")
    write_n_files(test, src_dir, n_files=STREAM_FILES, fmt="parquet", keys=["o_orderkey"])
    stream = parquet_stream(spark, src_dir, data.schema, max_files_per_trigger=FILES_PER_TRIGGER)
    out = scratch_path(spark, "score-metrics")
    run_available(
        stream, "append", foreach_batch=metrics_per_batch(model, out, "rating", digits=METRIC_DIGITS)
    )
    schema = (
        "accuracy double, weighted_precision double, weighted_recall double, "
        "weighted_f1 double, batch_id long"
    )
    return spark.read.schema(schema).option("basePath", out).parquet(os.path.join(out, "batch_id=*"))


QUERIES = {
    "stream_trending_tags": stream_trending_tags,
    "stream_late_data": stream_late_data,
    "stream_updates": stream_updates,
    "stream_tree_confusion": stream_tree_confusion,
    "stream_batch_metrics": stream_batch_metrics,
}

# Append mode emits a window once the watermark (max event time seen - 24 h)
# passes its end; late rows reach the stream after the watermark passed
# their windows and are dropped. So: on-time rows only, windows ending at
# or before the final watermark.
ORACLE_SQL = {
    "stream_late_data": """
WITH tagged AS (
  SELECT event_id, ts,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE event_type || ',u' || CAST(user_id % 3 AS VARCHAR) END AS tags
  FROM events WHERE event_id % 10 <> 3
),
exploded AS (
  SELECT ts, UNNEST(STRING_SPLIT(tags, ',')) AS tag FROM tagged WHERE tags IS NOT NULL
),
w AS (
  SELECT TIME_BUCKET(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS window_start,
         TIME_BUCKET(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE + INTERVAL 60 MINUTE
           AS window_end,
         tag, COUNT(*) AS tag_count
  FROM exploded, (VALUES (0), (1)) AS o(k)
  GROUP BY ALL
)
SELECT window_start, window_end, tag, tag_count FROM w
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR
""",
}
ORACLE_SQL["stream_tree_confusion"] = (
    f"{TREE_SQL} SELECT label, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, COUNT(*) AS n FROM scored GROUP BY ALL"
)
