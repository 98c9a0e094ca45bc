"""Loops taken up from their state folder: same results, no round run twice."""

import os

import pytest

from quarry.operators import graph as G
from quarry.operators import ranking as R
from quarry.operators import rounds as RO
from quarry.plans import tables as TB

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def computed(monkeypatch):
    """The steps that loops compute, per call."""
    calls = []
    plain = RO.Rounds.keep

    def keep(self, step, make):
        before = len(self.computed)
        out = plain(self, step, make)
        calls.extend(self.computed[before:])
        return out

    monkeypatch.setattr(RO.Rounds, "keep", keep)
    return calls


def stored_links(spark, folder):
    path = f"{folder}/links"
    TB._graph_links(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def ranks(df):
    return {r.page: r["rank"] for r in df.collect()}


def test_ranks_go_on_after_round_four(spark, tmp_dir, computed):
    links = stored_links(spark, tmp_dir)
    want = ranks(R.pagerank(links, iterations=10))
    state = f"{tmp_dir}/state"
    R.pagerank(links, iterations=4, checkpoint_every=2, state=state)
    computed.clear()
    got = ranks(R.pagerank(links, iterations=10, checkpoint_every=2, state=state))
    assert got == pytest.approx(want, rel=1e-12)
    assert computed == ["ranks-6", "ranks-8", "ranks-10"]
    computed.clear()
    assert ranks(R.pagerank(links, iterations=10, checkpoint_every=2, state=state)) == got and computed == []
    assert ranks(R.pagerank(links, iterations=4, state=state)) == pytest.approx(ranks(R.pagerank(links, iterations=4)))


def test_a_round_cut_off_in_the_middle_runs_again(spark, tmp_dir, computed):
    links = stored_links(spark, tmp_dir)
    state = f"{tmp_dir}/state"
    R.pagerank(links, iterations=6, checkpoint_every=2, state=state)
    os.remove(f"{state}/ranks-6/_SUCCESS")
    computed.clear()
    got = ranks(R.pagerank(links, iterations=6, checkpoint_every=2, state=state))
    assert computed == ["ranks-6"] and got == pytest.approx(ranks(R.pagerank(links, iterations=6)))


@pytest.mark.parametrize("limit", [8 << 20, 64])
def test_hops_go_on_after_level_two(spark, tmp_dir, computed, limit):
    g = TB.stored_routes_graph(spark, SF)
    marks = [1, 2, 3]
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    want = rows(G.hops_to_landmarks(g, marks))
    state = f"{tmp_dir}/state"
    part = rows(G.hops_to_landmarks(g, marks, max_hops=2, broadcast_bytes=limit, state=state))
    assert part == [r for r in want if r[2] <= 2]
    computed.clear()
    assert rows(G.hops_to_landmarks(g, marks, broadcast_bytes=limit, state=state)) == want
    assert computed and all(int(s.split("-")[1]) > 2 for s in computed)


def test_another_input_is_refused(spark, tmp_dir):
    links = stored_links(spark, tmp_dir)
    state = f"{tmp_dir}/state"
    R.pagerank(links, iterations=1, state=state)
    with pytest.raises(ValueError, match="another loop"):
        R.pagerank(links.filter("page > 10"), iterations=1, state=state)
    with pytest.raises(ValueError, match="another loop"):
        R.pagerank(links, iterations=1, damping=0.85, state=state)


def test_levels_have_few_files(spark, tmp_dir):
    """Small levels are not cut into a file per bucket."""
    g = TB.stored_routes_graph(spark, SF)
    state = f"{tmp_dir}/state"
    G.hops_to_landmarks(g, [1], partitions=64, state=state)
    levels = [d for d in os.listdir(state) if d.startswith("level-")]
    files = [f for d in levels for f in os.listdir(f"{state}/{d}") if f.endswith(".parquet")]
    assert len(files) <= 9 * len(levels) and not [d for d in os.listdir(state) if d.startswith("visited")]
