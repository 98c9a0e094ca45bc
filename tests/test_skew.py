"""Hot-key inputs: one key holding about a third of the rows must give the
same answers as plain brute force (skew handling must never change results)."""

import math
import random

import pytest

from quarry.operators import graph as G
from quarry.operators import ranking as R
from quarry.operators import spatial as S
from quarry.operators import trends as T


def rank_brute(lines, rounds):
    """Dictionary version of the ranking semantics (lines kept separate)."""
    links = []
    for line in lines:
        w = line.split()
        if w:
            links.append((w[0], sorted(set(w[1:]))))
    pages = {p for p, _ in links}
    ranks = {p: 1.0 / len(pages) for p in pages}
    for _ in range(rounds):
        new = {}
        for p, ts in links:
            if p in ranks:
                for t in ts:
                    new[t] = new.get(t, 0.0) + ranks[p] / len(ts)
        ranks = new
    return ranks


def test_pagerank_hub_page(spark):
    rnd = random.Random(1)
    lines = ["hub " + " ".join(f"p{i}" for i in range(60))]  # one huge out-list
    lines += [f"p{i} hub p{rnd.randrange(60)}" for i in range(60)]  # everyone links the hub
    lines += [f"p{i} hub" for i in range(0, 60, 3)]  # second lines for some pages
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, value string")
    links = R.parse_link_lines(df, "value", "line_id")
    got = {r.page: r.rank for r in R.pagerank(R.link_edges(links), iterations=6, pages=links.select("page")).collect()}
    want = rank_brute(lines, 6)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


def test_hops_with_hub_in_degree(spark):
    # a third of all edges point into the landmark's neighbour "h"
    edges = [(f"s{i}", "h") for i in range(100)] + [("h", "L")]
    edges += [(f"c{i}", f"c{i+1}") for i in range(19)] + [("c19", "s0")]
    g = G.Graph.from_edges(spark.createDataFrame(edges, "src string, dst string"))
    got = {r.id: r.hops for r in G.hops_to_landmarks(g, "L").collect()}
    assert got["L"] == 0 and got["h"] == 1 and got["s5"] == 2
    assert got["c19"] == 3 and got["c0"] == 22
    assert len(got) == 2 + 100 + 20


def test_close_pairs_hot_cell(spark):
    rnd = random.Random(5)
    rows = [(f"a{i}", rnd.uniform(0, 5), rnd.uniform(0, 5)) for i in range(200)]
    rows += [(f"h{i}", 1.0 + rnd.uniform(0, 0.01), 1.0 + rnd.uniform(0, 0.01)) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    got = {(r.id_a, r.id_b) for r in S.close_pairs(df, 0.3).collect()}
    want = set()
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = rows[i], rows[j]
            if math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) <= 0.3:
                want.add((min(a[0], b[0]), max(a[0], b[0])))
    assert got == want


def test_trend_counts_hot_tag(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=i), "hot" if i % 3 == 0 else f"t{i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "ID long, Date timestamp, Hashtags string")
    rep = T.trending_tags(df, "Date", "Hashtags", min_count=0).collect()
    assert sum(r.Count for r in rep if r.Hashtags == "hot") == 2 * 200
    assert sum(r.Count for r in rep) == 2 * 600
