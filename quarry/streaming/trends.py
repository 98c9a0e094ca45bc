"""Streaming tag trends: the batch transform of ``quarry.operators.trends``
plus an event-time watermark, run incrementally with state in the
checkpoint location."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.functions.time import as_event_time
from quarry.operators.trends import explode_tags, trending, windowed_counts


def trending_tags_stream(
    stream: DataFrame,
    time_col: str,
    tags_col: str,
    min_count: int = 100,
    length: str = "60 minutes",
    slide: str | None = "30 minutes",
    watermark: str = "24 hours",
    count_alias: str = "Count",
) -> DataFrame:
    """Streaming ``(window, tag, count)`` above ``min_count``.

    The time column is made a ``TIMESTAMP`` (watermarks reject
    ``TIMESTAMP_NTZ``). In ``complete`` mode every group is kept and
    re-emitted; in ``update`` / ``append`` mode rows whose windows already
    closed under the watermark are dropped and state is evicted.
    """
    s = stream.withColumn(time_col, as_event_time(time_col))
    tagged = explode_tags(s, tags_col, keep=[time_col]).withWatermark(time_col, watermark)
    counts = windowed_counts(tagged, time_col, tags_col, length, slide, count_alias)
    return trending(counts, min_count, count_alias)
