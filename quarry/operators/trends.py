"""Tag counts in sliding time windows.

One transform serves batch and streaming input: the streaming job inserts a
watermark before the same grouping (see ``quarry.streaming.trends``).
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.strings import split_list


def explode_tags(
    df: DataFrame,
    tags_col: str,
    keep: list[str] | tuple[str, ...] = (),
    sep: str = ",",
    tag_alias: str | None = None,
) -> DataFrame:
    """One row per tag of a separated tag string; rows whose tag string is
    null give nothing, empty items are kept as ``''``."""
    out = tag_alias or tags_col
    return df.filter(F.col(tags_col).isNotNull()).select(
        *keep, F.explode(split_list(F.col(tags_col), sep)).alias(out)
    )


def windowed_counts(
    tagged: DataFrame,
    time_col: str,
    tag_col: str,
    length: str = "60 minutes",
    slide: str | None = "30 minutes",
    count_alias: str = "Count",
) -> DataFrame:
    """Rows per (time window, tag) as ``(window, tag, count)``. Each row
    falls in ``length / slide`` windows; a null time falls in none."""
    w = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    return tagged.groupBy(w.alias("window"), F.col(tag_col)).agg(
        F.count(F.lit(1)).alias(count_alias)
    )


def _seconds(spark, interval: str) -> int:
    """Length of a fixed interval such as ``90 minutes``."""
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moved = at + F.expr(f"INTERVAL {interval}")
    return spark.range(1).select(F.unix_seconds(moved.cast("timestamp")) - F.unix_seconds(at.cast("timestamp"))).first()[0]


def pane_counts(
    tagged: DataFrame,
    time_col: str,
    tag_col: str,
    length: str = "60 minutes",
    slide: str = "30 minutes",
    count_alias: str = "Count",
) -> DataFrame:
    """The rows of :func:`windowed_counts` in two levels: rows are counted per
    (pane, tag), where panes are the tumbling windows of the greatest common
    divisor of length and slide, and the panes' counts are then summed into
    the windows that hold them. A row takes part once, not ``length / slide``
    times, so what is grouped and shuffled doesn't grow with the overlap."""
    spark = tagged.sparkSession
    long, step = _seconds(spark, length), _seconds(spark, slide)
    if not 0 < step <= long:
        raise ValueError(f"the slide {slide!r} must be positive and at most the length {length!r}")
    pane = gcd(long, step)
    panes = tagged.groupBy(F.window(time_col, f"{pane} seconds").alias("pane"), F.col(tag_col)).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Windows start at multiples of the slide; those that hold a pane start at
    # most one length before the pane's end.
    start = F.unix_seconds(F.col("pane.start").cast("timestamp"))
    last = F.floor(start / step) * step
    first = F.ceil((start + pane - long) / step) * step
    starts = F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(step).cast("long")))
    spread = panes.select(starts.alias("at"), F.col(tag_col), "n")
    summed = spread.groupBy("at", tag_col).agg(F.sum("n").alias(count_alias))
    kind = tagged.schema[time_col].dataType
    bound = lambda seconds: F.timestamp_seconds(seconds).cast(kind)
    window = F.struct(bound(F.col("at")).alias("start"), bound(F.col("at") + long).alias("end"))
    return summed.select(window.alias("window"), tag_col, count_alias)


def flatten_window(df: DataFrame, ntz: bool = True) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end``
    (as ``TIMESTAMP_NTZ`` by default, the type of the driver tables)."""
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != "window"]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


def trending(
    counts: DataFrame, min_count: int, count_alias: str = "Count"
) -> DataFrame:
    """Window/tag groups with more than ``min_count`` rows (HAVING)."""
    return counts.filter(F.col(count_alias) > min_count)


def trending_tags(
    df: DataFrame,
    time_col: str,
    tags_col: str,
    min_count: int = 100,
    length: str = "60 minutes",
    slide: str | None = "30 minutes",
    count_alias: str = "Count",
    ntz: bool = True,
) -> DataFrame:
    """Static trend report: explode tags, count per sliding window and tag,
    keep groups above ``min_count``; ordered by window then count desc."""
    tagged = explode_tags(df, tags_col, keep=[time_col])
    counts = windowed_counts(tagged, time_col, tags_col, length, slide, count_alias)
    flat = flatten_window(trending(counts, min_count, count_alias), ntz=ntz)
    return flat.orderBy("window_start", F.col(count_alias).desc(), tags_col)
