import pytest
from pyspark.sql import functions as F

from quarry.operators import ranking as R
from quarry.operators.skew import hot_slices

#: The four-page example whose ranks are known.
GOLDEN_LINES = ["a b c", "b a a", "c b", "d a"]


def _ranks(spark, lines, **kw):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_id long, value string")
    links = R.parse_link_lines(df, "value", "line_id")
    return {r.page: r.rank for r in R.pagerank(R.link_edges(links), **kw).collect()}


def test_golden_four_pages(spark):
    got = _ranks(spark, GOLDEN_LINES, iterations=10)
    assert set(got) == {"a", "b", "c"}
    assert got["a"] == pytest.approx(0.3984375, abs=1e-12)
    assert got["b"] == pytest.approx(0.3984375, abs=1e-12)
    assert got["c"] == pytest.approx(0.203125, abs=1e-12)


def test_parse_collapses_blanks_and_dedups(spark):
    df = spark.createDataFrame([(1, "  p   x\ty x  p "), (2, "   ")], "line_id long, value string")
    out = R.parse_link_lines(df, "value", "line_id").collect()
    assert len(out) == 1 and out[0].page == "p" and out[0].targets == ["p", "x", "y"]


def test_page_on_two_lines_contributes_from_both(spark):
    got = _ranks(spark, ["a b", "a c", "b a", "c a"], iterations=1)
    # n = 3 pages; a sends 1/3 on each of its two lines
    assert got["b"] == pytest.approx(1 / 3) and got["c"] == pytest.approx(1 / 3)
    assert got["a"] == pytest.approx(2 / 3)


def test_total_rank_never_grows_with_one_line_per_page(spark):
    got = _ranks(spark, ["a b c", "b c", "c a", "d a b"], iterations=7)
    assert sum(got.values()) <= 1.0 + 1e-12


def test_damped_variant_optional(spark):
    got = _ranks(spark, ["a b", "b a"], iterations=5, damping=0.85)
    assert got["a"] == pytest.approx(0.5) and got["b"] == pytest.approx(0.5)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_partition_counts_agree(spark, partitions):
    got = _ranks(spark, GOLDEN_LINES, iterations=10, partitions=partitions)
    want = _ranks(spark, GOLDEN_LINES, iterations=10)
    assert got == pytest.approx(want, rel=1e-12)


def test_a_hot_pages_edges_are_spread(spark):
    """A page with a third of the edges fills no partition of its own."""
    n, parts = 6000, 8
    hot = spark.range(n // 3).selectExpr("'hot' AS page", "concat('t', id) AS target")
    rest = spark.range(n - n // 3).selectExpr("concat('p', id % 500) AS page", "concat('t', id) AS target")
    edges = hot.union(rest)
    placed = R.partitioned_edges(edges, hot_slices(edges, "page", parts), parts)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2.5 * n / parts
    # and so do its edges in a plain partitioning not
    plain = [r["count"] for r in edges.repartition(parts, "page").groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) >= n / 3
    ranks = R.pagerank(edges, iterations=1, partitions=parts)
    assert ranks.agg(F.sum("rank")).first()[0] == pytest.approx(1.0)


def test_graph_edges_divide_in_the_page_table(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("a", "b")], "src string, dst string")
    links = R.edges_as_links(edges)
    assert links.columns == ["page", "target"]
    got = {(r.page, r.target): r.contrib for r in R.contributions(links, R.initial_ranks(links)).collect()}
    assert got == {("a", "b"): 0.25, ("a", "c"): 0.25, ("b", "a"): 0.5}
