import os

import pytest

from quarry.operators import trends as T
from quarry.plans import tables as TB
from quarry.plans import tables_stream as TS
from quarry.streaming.sinks import start_update
from quarry.streaming.sources import parquet_stream
from quarry.streaming.trends import trending_tags_stream
from quarry.streaming.upsert import UpsertTable, upsert_sink

SF = "/root/testdata/sf0.001"
KEYS = ["k", "t"]
SCHEMA = "k long, t string, n long"


def table(spark, path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return UpsertTable(spark, path, KEYS, schema, **options)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("every", [2, 3, 100])
def test_latest_row_per_key(spark, tmp_dir, every):
    t = table(spark, f"{tmp_dir}/t", compact_every=every, buckets=3)
    assert t.read().count() == 0
    want = {}
    for b in range(7):
        new = [(k, "xé"[k % 2], 10 * b + k) for k in range(b, b + 4)] + [(None if b % 2 else 99, None if b % 3 else "", b)]
        t.apply(batch(spark, new), b)
        want |= {r[:2]: r for r in new}
        got = {r[:2]: r for r in (tuple(x) for x in t.read().collect())}
        assert got == want, b
        again = dict(got)
        t.apply(batch(spark, new), b)  # replayed
        assert {r[:2]: r for r in (tuple(x) for x in t.read().collect())} == again


def test_unfinished_batches_and_bases_are_not_read(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t", compact_every=2)
    t.apply(batch(spark, [(1, "a", 1)]), 0)
    t.apply(batch(spark, [(1, "a", 2), (2, "b", 5)]), 1)
    t.apply(batch(spark, [(1, "a", 3)]), 2)
    os.remove(f"{tmp_dir}/t/batch=2/_SUCCESS")
    assert rows(t.read()) == [(1, "a", 2), (2, "b", 5)]
    os.remove(f"{tmp_dir}/t/base=1/_SUCCESS")
    assert rows(t.read()) == [(1, "a", 2), (2, "b", 5)]
    t.apply(batch(spark, [(1, "a", 3)]), 2)
    t.apply(batch(spark, [(3, "c", 1)]), 3)
    assert rows(t.read()) == [(1, "a", 3), (2, "b", 5), (3, "c", 1)]


def test_old_folders_go(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t", compact_every=2)
    for b in range(8):
        t.apply(batch(spark, [(b, "a", b)]), b)
    left = {d for d in os.listdir(f"{tmp_dir}/t")}
    assert "base=7" in left and "base=1" not in left and "batch=1" not in left
    assert len(rows(t.read())) == 8


def test_names(spark, tmp_dir):
    schema = spark.createDataFrame([], "k long, upsert_batch long").schema
    with pytest.raises(ValueError):
        UpsertTable(spark, tmp_dir, ["k"], schema)
    with pytest.raises(ValueError):
        UpsertTable(spark, tmp_dir, ["other"], schema)


def test_equals_the_batch_report_after_every_block(spark, tmp_dir):
    """Blocks in order of event time, a restart in between, and the table
    holds the counts of all blocks so far after each."""
    events = TB.tagged_events(spark, SF).withColumnRenamed("tags", "tag")
    days = [r[0] for r in events.selectExpr("date_trunc('week', ts) AS d").distinct().orderBy("d").limit(5).collect()]
    src, ck, out = (f"{tmp_dir}/{d}" for d in ("src", "ck", "out"))
    events.limit(0).write.parquet(src)
    trend = trending_tags_stream(parquet_stream(spark, src, events.schema), "ts", "tag", 0, count_alias="n")
    seen = events.limit(0)
    for day in days:
        block = events.filter(f"date_trunc('week', ts) = TIMESTAMP'{day}'")
        block.write.mode("append").parquet(src)
        seen = seen.unionByName(block)
        held, take = upsert_sink(
            spark, out, ["window_start", "window_end", "tag"], T.flatten_window, T.flatten_window(trend).schema, compact_every=2
        )
        query = start_update(trend, take, checkpoint=ck)  # a new query each time: it goes on from its checkpoint
        query.processAllAvailable()
        query.stop()
        want = T.flatten_window(T.windowed_counts(T.explode_tags(seen, "tag", keep=["ts"]), "ts", "tag", count_alias="n"))
        assert rows(held.read()) == rows(want)


def test_query_equals_its_batch_twin(spark):
    assert rows(TS.stream_updates(spark, SF)) == rows(TB.trending_tags(spark, SF))
