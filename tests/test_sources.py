import os

import pytest
from pyspark.sql import functions as F

from quarry.plans.explain import partition_filters
from quarry.session import scratch_path
from quarry.sources import csv as CSV
from quarry.sources.sinks import write_n_files, write_partitioned

STRICT_SCHEMA = "ID long, Date timestamp, L long"


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)


def test_strict_csv_same_rows_under_any_projection(spark, tmp_dir):
    # golden: IDs 1 and 5 survive (bad L, bad ID, short row, extra field dropped)
    _write(
        tmp_dir,
        "ID,Date,L\n"
        "1,2024-01-01 00:00:00,10\n"
        "2,2024-01-01 00:00:00,notnum\n"
        "x,2024-01-01 00:00:00,3\n"
        "4,2024-01-01 00:00:00\n"
        "5,2024-01-01 00:00:00,\n"
        "6,2024-01-01 00:00:00,6,extra\n",
    )
    df = CSV.read_csv_strict(spark, tmp_dir, STRICT_SCHEMA, header=True)
    assert df.count() == 2
    assert sorted(r.ID for r in df.select("ID").collect()) == [1, 5]
    assert sorted(r.ID for r in df.collect()) == [1, 5]
    assert df.select("Date").count() == 2
    assert df.filter(F.col("ID") == 5).select("L").collect()[0].L is None


def test_strict_csv_streaming_matches_batch(spark, tmp_dir):
    from quarry.streaming.sources import text_stream
    from quarry.streaming.sinks import run_available

    src = os.path.join(tmp_dir, "src")
    _write(src, "1,2024-01-01 00:00:00,10\n2,2024-01-01 00:00:00,zz\n3,2024-01-01 00:00:00,3\n")
    parsed = CSV.strict_csv_lines(text_stream(spark, src), STRICT_SCHEMA)
    run_available(parsed, "append", query_name="strict_stream_t", checkpoint=os.path.join(tmp_dir, "ck"))
    got = sorted(r.ID for r in spark.table("strict_stream_t").collect())
    assert got == [1, 3]


def test_by_header_picks_names_and_drops_empty(spark, tmp_dir):
    _write(
        tmp_dir,
        "birthState,playerID,height,birthCountry\n"
        "CO,p1,70,USA\n"
        "CA,p2,,USA\n"
        ",p3,72,\n",
    )
    df = CSV.read_csv_by_header(
        spark,
        tmp_dir,
        {"playerID": "string", "birthCountry": "string", "birthState": "string", "height": "int"},
        required=["height"],
    )
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("p1", "USA", "CO", 70), ("p3", "", "", 72)]
    assert df.schema["height"].dataType.simpleString() == "int"


def test_by_header_bad_number_raises(spark, tmp_dir):
    _write(tmp_dir, "id,height\na,7x\n")
    df = CSV.read_csv_by_header(spark, tmp_dir, {"id": "string", "height": "int"}, required=["height"])
    with pytest.raises(Exception):
        df.collect()


def test_points_glob(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a"), "p1,0.5,1.5\n")
    with open(os.path.join(tmp_dir, "a", "more.csv"), "w") as f:
        f.write("p2,2.0,-1.0\n")
    df = CSV.read_points_csv(spark, os.path.join(tmp_dir, "a", "*.csv"))
    assert sorted((r.id, r.x, r.y) for r in df.collect()) == [("p1", 0.5, 1.5), ("p2", 2.0, -1.0)]


def test_partitioned_write_prunes_and_fails_if_exists(spark):
    df = spark.createDataFrame(
        [("a", "Rockies"), ("b", "Rockies"), ("c", "Cubs")], "player string, team string"
    )
    path = scratch_path(spark, "t-part")
    write_partitioned(df, path, ["team"])
    back = spark.read.schema("player string, team string").parquet(path).filter(F.col("team") == "Rockies")
    assert any("team" in f for f in partition_filters(back))
    assert sorted(r.player for r in back.collect()) == ["a", "b"]
    with pytest.raises(Exception):
        write_partitioned(df, path, ["team"])


def test_n_file_writer(spark):
    df = spark.range(0, 100, 1, 2)
    path = scratch_path(spark, "t-nfiles")
    write_n_files(df, path, n_files=5, fmt="csv")
    local = path[5:] if path.startswith("file:") else path
    files = [f for f in os.listdir(local) if f.endswith(".csv")]
    assert len(files) == 5
    assert spark.read.csv(path, schema="id long").count() == 100


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_FIELD = {
    "ID": st.sampled_from(["1", "22", "x", "", "7"]),
    "Date": st.sampled_from(["2024-01-01 00:00:00", "2024-02-03 04:05:06", "notadate"]),
    "L": st.sampled_from(["5", "", "z9", "-3"]),
}


def _valid(fields):
    if len(fields) != 3:
        return False
    i, d, l_ = fields
    # an empty field is a well-formed null
    return (i == "" or i.lstrip("-").isdigit()) and d != "notadate" and (
        l_ == "" or l_.lstrip("-").isdigit()
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(_FIELD["ID"], _FIELD["Date"], _FIELD["L"], st.sampled_from([0, 0, 0, 1, -1])),
        min_size=1,
        max_size=12,
    )
)
def test_strict_csv_projection_invariant(spark, tmp_path_factory, rows):
    lines, keep = [], 0
    for i, d, l_, shape in rows:
        fields = [i, d, l_] + (["extra"] if shape == 1 else [])
        if shape == -1:
            fields = fields[:2]
        lines.append(",".join(fields))
        keep += _valid(fields)
    path = str(tmp_path_factory.mktemp("strict"))
    _write(path, "\n".join(lines) + "\n")
    df = CSV.read_csv_strict(spark, path, STRICT_SCHEMA, header=False)
    counts = {
        df.count(),
        len(df.collect()),
        df.select("ID").count(),
        df.select("L").count(),
        df.select("Date").count(),
    }
    assert counts == {keep}


def test_blank_lines_are_no_records(spark, tmp_dir):
    strict_csv_lines = CSV.strict_csv_lines
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("k,v\n1,x\n\n   \n2,y\n\n")
    out = CSV.read_csv_strict(spark, f"{tmp_dir}/a.csv", "k int, v string")
    assert sorted(map(tuple, out.collect())) == [(1, "x"), (2, "y")]
    os.makedirs(f"{tmp_dir}/in")
    os.replace(f"{tmp_dir}/a.csv", f"{tmp_dir}/in/a.csv")
    lines = spark.readStream.text(f"{tmp_dir}/in")
    stream = strict_csv_lines(lines, "k int, v string", header_line="k,v")
    q = stream.writeStream.format("memory").queryName("blank_lines").option(
        "checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("blank_lines").collect())) == [(1, "x"), (2, "y")]
    spark.catalog.dropTempView("blank_lines")


def test_many_partitions_keep_their_tasks(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 40)
    write_n_files(df, f"{tmp_dir}/wide", n_files=20, keys=["id"])
    write_n_files(df.coalesce(2), f"{tmp_dir}/few", n_files=20, max_rows=50)
    files = lambda d: [f for f in os.listdir(f"{tmp_dir}/{d}") if f.startswith("part-")]
    assert len(files("wide")) == 40 and len(files("few")) >= 4000 / 50


def test_session_setting_comes_first(spark):
    from quarry.session import ensure_checkpoint_dir

    want = spark.conf.get("spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(f"{want}/other")
    assert ensure_checkpoint_dir(spark) == want and scratch_path(spark, "x").startswith(f"{want}/quarry-scratch/")
