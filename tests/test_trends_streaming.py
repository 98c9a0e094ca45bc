import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators import trends as T
from quarry.plans import tables as TB
from quarry.plans import tables_stream as TS
from quarry.streaming.sinks import run_available
from quarry.streaming.sources import parquet_stream
from quarry.streaming.trends import trending_tags_stream
from tests.conftest import SF_SMALL

SCHEMA = "ID long, Date timestamp, Hashtags string"


def test_tags_null_and_empty(spark):
    rows = [
        (1, dt.datetime(2024, 1, 1, 0, 5), "x,y"),
        (2, dt.datetime(2024, 1, 1, 0, 6), None),
        (3, dt.datetime(2024, 1, 1, 0, 7), "x,,x"),
        (4, None, "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    tags = sorted((r.ID, r.Hashtags) for r in T.explode_tags(df, "Hashtags", keep=["ID"]).collect())
    assert tags == [(1, "x"), (1, "y"), (3, ""), (3, "x"), (3, "x"), (4, "x")]
    rep = T.trending_tags(df, "Date", "Hashtags", min_count=0).collect()
    per = {(r.window_start.hour, r.window_start.minute, r.Hashtags): r.Count for r in rep}
    # two windows per row: [23:30, 00:30) and [00:00, 01:00); the null-time row counts nowhere
    assert per[(0, 0, "x")] == 3 and per[(23, 30, "x")] == 3 and per[(0, 0, "")] == 1
    assert sum(r.Count for r in rep) == 2 * 5


def test_stream_equals_batch_on_tables(spark):
    a = sorted(tuple(r) for r in TB.trending_tags(spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in TS.stream_trending_tags(spark, SF_SMALL).collect())
    assert a == b


def _late_run(spark, root, mode):
    """Four single-row files, one batch each (the late-data golden)."""
    src = os.path.join(root, f"src-{mode}")
    rows = [
        (1, dt.datetime(2024, 1, 10, 0, 10), "x"),
        (2, dt.datetime(2024, 1, 11, 12, 0), "z"),
        (3, dt.datetime(2024, 1, 11, 12, 5), "z"),
        (4, dt.datetime(2024, 1, 10, 0, 20), "x"),
    ]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"f{i}"))
        time.sleep(1.1)
    # move the part files to one directory in order (file source needs a flat dir)
    flat = os.path.join(root, f"flat-{mode}")
    os.makedirs(flat)
    for i in range(len(rows)):
        d = os.path.join(src, f"f{i}")
        for name in sorted(os.listdir(d)):
            if name.endswith(".parquet"):
                with open(os.path.join(d, name), "rb") as fi, open(os.path.join(flat, f"{i}.parquet"), "wb") as fo:
                    fo.write(fi.read())
        time.sleep(1.1)
    stream = parquet_stream(spark, flat, SCHEMA, max_files_per_trigger=1)
    trend = trending_tags_stream(stream, "Date", "Hashtags", min_count=0)
    name = f"late_{mode}"
    q = run_available(trend, mode, query_name=name, checkpoint=os.path.join(root, f"ck-{mode}"))
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in q.recentProgress
        for op in p.get("stateOperators", [])
    )
    rows = spark.table(name).collect()
    x = {}
    for r in rows:
        if r.Hashtags == "x":
            x[r.window.start] = max(x.get(r.window.start, 0), r.Count)
    return x, dropped


def test_late_data_modes(spark, tmp_dir):
    x, _ = _late_run(spark, tmp_dir, "complete")
    assert sorted(x.values()) == [2, 2]
    for mode in ("update", "append"):
        x, dropped = _late_run(spark, tmp_dir, mode)
        assert sorted(x.values()) == [1, 1], mode
        assert dropped == 2, mode


def test_batch_metrics_stream_rows(spark):
    out = TS.stream_batch_metrics(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.batch_id for r in out) == [0, 1, 2, 3]
    assert all(0.0 <= r.accuracy <= 1.0 for r in out)


def test_complete_mode_resumes_from_checkpoint(spark, tmp_dir):
    """Half the files, stop, the rest, restart on the same checkpoint: the
    overwritten complete-mode table equals the batch result over all rows."""
    from quarry.sources.sinks import write_n_files
    from quarry.streaming.sinks import read_latest
    from quarry.streaming.sources import csv_stream

    staged = TB.tagged_events(spark, SF_SMALL).withColumnRenamed("tags", "tag")
    first, second = staged.filter("event_id < 500"), staged.filter("event_id >= 500")
    src, ck, out = (os.path.join(tmp_dir, d) for d in ("src", "ck", "out"))
    schema = "event_id long, ts timestamp, tag string"

    def run():
        stream = csv_stream(spark, src, schema, max_files_per_trigger=2)
        trend = trending_tags_stream(stream, "ts", "tag", 0, count_alias="tag_count")
        run_available(trend, "complete", sink_path=out, checkpoint=ck)

    write_n_files(first, src, n_files=4, fmt="csv", mode="append")
    run()
    write_n_files(second, src, n_files=4, fmt="csv", mode="append")
    run()
    got = sorted(tuple(r) for r in T.flatten_window(read_latest(spark, out)).collect())
    want = sorted(
        tuple(r) for r in T.trending_tags(staged, "ts", "tag", 0, count_alias="tag_count").collect()
    )
    assert got == want


def test_tumbling_window_without_slide(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=20 * i), "t") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    rep = T.trending_tags(df, "Date", "Hashtags", min_count=0, slide=None).collect()
    assert [(r.window_start.hour, r.Count) for r in rep] == [(0, 3), (1, 3)]


def test_a_half_written_batch_leaves_the_last_result(spark, tmp_dir):
    import os

    from quarry.streaming.sinks import read_latest, result_table

    for batch, done in ((3, True), (4, False)):
        spark.range(batch).write.parquet(f"{tmp_dir}/out/batch={batch}")
        if not done:
            os.remove(f"{tmp_dir}/out/batch={batch}/_SUCCESS")
    assert read_latest(spark, f"{tmp_dir}/out").count() == 3
    result_table(spark, "last_result", f"{tmp_dir}/out")
    assert spark.sql("SELECT COUNT(*) AS n FROM last_result").first().n == 3
    spark.sql("DROP TABLE last_result")
    assert read_latest(spark, f"{tmp_dir}/out").count() == 3


def test_forest_scores_every_batch(spark):
    from quarry.plans import tables_stream as TS

    rows = TS.stream_batch_metrics(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 4 and all(0 < r.accuracy <= 1 for r in rows)


@pytest.mark.parametrize("length, slide", [("60 minutes", "30 minutes"), ("60 minutes", "60 minutes"), ("90 minutes", "60 minutes"), ("7 hours", "2 hours")])
def test_panes_equal_windows(spark, length, slide):
    events = T.explode_tags(TB.tagged_events(spark, SF_SMALL), "tags", keep=["ts"])
    events = events.unionByName(events.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    rows = lambda df: sorted(tuple(r) for r in T.flatten_window(df).collect())
    assert rows(T.pane_counts(events, "ts", "tags", length, slide)) == rows(T.windowed_counts(events, "ts", "tags", length, slide))
    with pytest.raises(ValueError):
        T.pane_counts(events, "ts", "tags", "30 minutes", "60 minutes")


def test_panes_don_t_multiply_rows(spark):
    """With a window of 24 slides each row is grouped once, not 24 times: no
    Expand in front of the first exchange."""
    events = T.explode_tags(TB.tagged_events(spark, SF_SMALL), "tags", keep=["ts"])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan(T.windowed_counts(events, "ts", "tags", "24 hours", "1 hour"))
    panes = T.pane_counts(events, "ts", "tags", "24 hours", "1 hour")
    assert "Expand" not in plan(panes)
    # the rows that the second exchange gets are pane counts, at most a row per pane and tag and window
    n = events.count()
    assert T.pane_counts(events.union(events).union(events), "ts", "tags", "24 hours", "1 hour").count() == panes.count()
    assert panes.agg(F.sum("Count")).first()[0] == 24 * n
