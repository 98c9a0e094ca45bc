"""Many landmarks as bits, closed motifs by degree order, dense ids."""

import itertools
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from quarry.ml import dictionary as D
from quarry.operators import cycles as CY
from quarry.operators import graph as G
from quarry.operators import landmarks as LM
from quarry.operators import ranking as R
from quarry.operators.rounds import Rounds
from quarry.session import DROP_SHUFFLES

NAMES = "src long, dst long"


def graph(spark, edges):
    return G.Graph.from_edges(spark.createDataFrame(edges, NAMES).distinct())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def random_edges(seed, n=60, m=260):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(0, i) for i in range(n)]


def test_bits_equal_rows_per_landmark(spark):
    g = graph(spark, random_edges(1, 90, 200) + [(500, 501), (501, 502)])
    marks = [*range(0, 90), 502, 9999]  # two blocks; one is no vertex
    table = spark.createDataFrame([(m,) for m in marks + [3, 3]], "landmark long")
    assert rows(LM.hops_to_many(g, table)) == rows(G.hops_to_landmarks(g, marks))
    assert rows(LM.hops_to_many(g, table, max_hops=2)) == rows(G.hops_to_landmarks(g, marks, max_hops=2))
    assert LM.hops_to_many(g, table.limit(0)).count() == 0


def test_many_landmarks_go_on_from_their_state(spark, tmp_dir):
    spark.createDataFrame(random_edges(2, 80, 120), NAMES).distinct().write.parquet(f"{tmp_dir}/e")
    spark.range(0, 80, 5).withColumnRenamed("id", "landmark").write.parquet(f"{tmp_dir}/m")
    g, marks = G.Graph.from_edges(spark.read.parquet(f"{tmp_dir}/e")), spark.read.parquet(f"{tmp_dir}/m")
    want = rows(LM.hops_to_many(g, marks))
    state = f"{tmp_dir}/s"
    LM.hops_to_many(g, marks, max_hops=2, state=state)
    assert rows(LM.hops_to_many(g, marks, state=state)) == want


def test_only_the_levels_of_many_landmarks_are_kept(spark, tmp_dir):
    """No table of all bits seen so far is written beside every level, and a
    vertex has one row for hundreds of landmarks."""
    n = 300
    spark.createDataFrame([(i, (i + 1) % n) for i in range(n)] + [(i, (i * 7) % n) for i in range(n)], NAMES) \
        .distinct().write.parquet(f"{tmp_dir}/e")
    g = G.Graph.from_edges(spark.read.parquet(f"{tmp_dir}/e"))
    marks = g.vertices.withColumnRenamed("id", "landmark")
    out = LM.hops_to_many(g, marks, max_hops=3, state=f"{tmp_dir}/s")
    assert not [name for name in os.listdir(f"{tmp_dir}/s") if name.startswith("seen")]
    assert spark.read.parquet(f"{tmp_dir}/s/level-0").count() == n
    for level in (1, 2, 3):
        assert spark.read.parquet(f"{tmp_dir}/s/level-{level}").count() <= n  # 300 landmarks, one block
    want = []
    for mark in range(n):
        hops, edge = {mark: 0}, {mark}
        for level in (1, 2, 3):
            edge = {i for i in range(n) if {(i + 1) % n, (i * 7) % n} & edge} - set(hops)
            hops.update(dict.fromkeys(edge, level))
        want += [(i, mark, h) for i, h in hops.items()]
    assert rows(out) == sorted(want)


def test_blocks_are_searched_in_groups(spark, tmp_dir, monkeypatch):
    """No step of the search moves the bits of all blocks at once, and what the
    steps shuffled is gone when they are written."""
    monkeypatch.setattr(LM, "WORDS", 1)
    monkeypatch.setattr(LM, "GROUP", 2)
    n = 150
    edges = {(i, (i * 7 + k) % n) for i in range(n) for k in (1, 2)}
    spark.createDataFrame(sorted(edges), NAMES).write.parquet(f"{tmp_dir}/e")
    g = G.Graph.from_edges(spark.read.parquet(f"{tmp_dir}/e"))
    marks = g.vertices.withColumnRenamed("id", "landmark")
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        found = {name for top in dirs for _, _, names in os.walk(top) for name in names}
        return {name.split("_")[1] for name in found if name.startswith("shuffle_")}

    at_first, before = shuffled(), spark.conf.get(DROP_SHUFFLES, None)
    out = LM.hops_to_many(g, marks, max_hops=2, partitions=4, state=f"{tmp_dir}/s")
    assert spark.conf.get(DROP_SHUFFLES, None) == before
    for _ in range(100):  # files go in the background
        if len(left := shuffled() - at_first) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1  # the reversed edges
    for first in (0, 2):  # three blocks
        level = spark.read.parquet(f"{tmp_dir}/s/blocks-{first}-{first + 1}/level-2")
        assert {r.block for r in level.select("block").collect()} == {first, first + 1} - {3}
    want = [(i, i, 0) for i in range(n)]
    for mark in range(n):
        one = {a for a, b in edges if b == mark} - {mark}
        two = {a for a, b in edges if b in one} - one - {mark}
        want += [(i, mark, 1) for i in one] + [(i, mark, 2) for i in two]
    assert rows(out) == sorted(want)
    assert rows(LM.hops_to_many(g, marks, max_hops=2, partitions=4, state=f"{tmp_dir}/s")) == sorted(want)


def test_too_many_landmarks_are_refused(spark, monkeypatch):
    monkeypatch.setattr(LM, "MAX_LANDMARKS", 3)
    g = graph(spark, random_edges(3))
    with pytest.raises(ValueError):
        LM.hops_to_many(g, g.vertices.withColumnRenamed("id", "landmark"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_triangles_equal_brute_force(spark, seed):
    edges = set(random_edges(seed, 25, 160))
    want = sorted(
        (a, b, c) for a, b, c in itertools.permutations(range(25), 3)
        if a < b and a < c and {(a, b), (b, c), (c, a)} <= edges
    )
    assert rows(CY.directed_triangles(graph(spark, sorted(edges)))) == want and want
    motif = G.find_motif(graph(spark, sorted(edges)), [("a", "b"), ("b", "c"), ("c", "a")])
    assert rows(motif.where("a < b AND a < c AND b <> c").select("a", "b", "c")) == want


def test_a_star_makes_no_wedges(spark):
    n = 3000
    star = [(0, i) for i in range(1, n)] + [(i, 0) for i in range(1, n)] + [(5, 6), (6, 7)]
    edges = CY.ordered_edges(graph(spark, star))
    # 5-6 and 6-7 close with the hub: the two wedges that are there, not n squared.
    assert CY.wedges(edges).count() <= 4
    assert rows(CY.directed_triangles(graph(spark, star))) == [(0, 5, 6), (0, 6, 7)]


def test_dense_ids_give_the_same_ranks(spark):
    edges = spark.createDataFrame(random_edges(4), NAMES).distinct()
    named = edges.select(F.concat(F.lit("page "), "src").alias("src"), F.concat(F.lit("page "), "dst").alias("dst"))
    g, names = G.dense_ids(G.Graph.from_edges(named))
    ids = sorted(r.id for r in g.vertices.collect())
    assert ids == list(range(names.size))
    back = D.decode(R.pagerank(R.edges_as_links(g.edges), iterations=5), "page", names, "name")
    want = {r.page: r["rank"] for r in R.pagerank(R.edges_as_links(named), iterations=5).collect()}
    assert {r.name: r["rank"] for r in back.select("name", "rank").collect()} == pytest.approx(want)
