from pyspark.sql import functions as F

from quarry.operators import relational as R
from quarry.plans import tables as T
from tests.conftest import SF_SMALL


def test_count_routes_agree(spark):
    a = T.count_where(spark, SF_SMALL).collect()
    b = T.count_where_sql(spark, SF_SMALL).collect()
    assert a == b and a[0]["n"] > 0


def test_avg_routes_agree(spark):
    a = T.avg_by_group(spark, SF_SMALL).collect()
    b = T.avg_by_group_sql(spark, SF_SMALL).collect()
    assert a == b
    vals = [r["avg_size"] for r in a]
    assert vals == sorted(vals, reverse=True)


def test_row_loss_single_pass(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (4, "d")], "k int, v string")
    r = R.row_loss(df).collect()[0]
    assert (r.n_before, r.n_after, r.loss_pct) == (4, 2, 50.0)
    assert R.drop_incomplete(df).count() == 2


def test_union_distinct_by_position(spark):
    a = spark.createDataFrame([("x",), ("y",)], "src string")
    b = spark.createDataFrame([("y",), ("z",)], "dst string")
    out = R.union_distinct(a, b)
    assert out.columns == ["src"]
    assert sorted(r[0] for r in out.collect()) == ["x", "y", "z"]


def test_link_join_is_inner_and_distinct(spark):
    link = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 99)], "p int, t int")
    left = spark.createDataFrame([(1, "a"), (2, "b")], "p int, name string")
    right = spark.createDataFrame([(10, "T10"), (20, "T20")], "t int, team string")
    out = R.link_join(link, left, "p", right, "t").collect()
    assert sorted((r.p, r.t, r.name, r.team) for r in out) == [(1, 10, "a", "T10"), (2, 20, "b", "T20")]


def test_sql_twin_binds_value(spark):
    df = spark.createDataFrame([("CO",), ("CO",), ("x' OR '1'='1",)], "s string")
    assert R.count_where_sql(df, "s", "CO").collect()[0]["n"] == 2


def test_top_n_total_order(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)], "k int, v double")
    out = R.top_n(df, 2, [F.col("v").desc(), F.col("k")]).collect()
    assert [r.k for r in out] == [2, 3]


def test_row_loss_empty_input(spark):
    df = spark.createDataFrame([], "k int, v string")
    r = R.row_loss(df).collect()[0]
    assert (r.n_before, r.n_after, r.loss_pct) == (0, 0, None)
