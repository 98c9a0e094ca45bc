import pytest

from quarry.operators import graph as G
from quarry.plans import tables as T
from tests.conftest import SF_SMALL

# golden graph: edges A->DEN, DEN->A, B->DEN, DEN->C, D->B, E->D, F->E,
# DEN->DEN, G->G, C->H
EDGES = [
    ("A", "DEN"), ("DEN", "A"), ("B", "DEN"), ("DEN", "C"), ("D", "B"),
    ("E", "D"), ("F", "E"), ("DEN", "DEN"), ("G", "G"), ("C", "H"),
]


@pytest.fixture()
def g(spark):
    return G.Graph.from_edges(spark.createDataFrame(EDGES, "src string, dst string"))


def test_one_way_neighbors_of_hub(g):
    got = sorted(r.id for r in G.one_way_neighbors(g, "DEN").collect())
    assert got == ["B", "C"]


def test_one_way_edges_disjoint_from_reverse(g):
    ow = {(r.a, r.b) for r in G.one_way_edges(g).collect()}
    assert all((b, a) not in ow for a, b in ow)
    assert ("DEN", "DEN") not in ow and ("G", "G") not in ow


def test_hops_to_landmark(g):
    h = {r.id: r.hops for r in G.hops_to_landmarks(g, "DEN").collect()}
    assert h == {"DEN": 0, "A": 1, "B": 1, "D": 2, "E": 3, "F": 4}


def test_hops_map_nulls_for_unreachable(g):
    m = {r.id: r.distances for r in G.hops_map(g, G.hops_to_landmarks(g, ["DEN", "H"])).collect()}
    assert m["C"] == {"H": 1} and m["G"] == {} and m["DEN"]["DEN"] == 0 and m["DEN"]["H"] == 2


def test_far_from_landmark_sorted(g):
    out = G.far_from_landmark(G.hops_to_landmarks(g, "DEN"), "DEN", 3).collect()
    assert [(r.id, r.hops) for r in out] == [("E", 3), ("F", 4)]


def test_vertices_are_edge_ids(g):
    ids = {r.id for r in g.vertices.collect()}
    assert ids == {a for a, _ in EDGES} | {b for _, b in EDGES}


def test_edges_within_semi_join_no_multiplication(spark):
    routes = spark.createDataFrame([("A", "B"), ("A", "B"), ("B", "C")], "s string, d string")
    allowed = spark.createDataFrame([("A",), ("A",), ("B",)], "code string")
    out = G.edges_within(routes, "s", "d", allowed, "code").collect()
    assert [(r.src, r.dst) for r in out] == [("A", "B")]


def test_motif_rejects_disconnected_terms(g):
    with pytest.raises(ValueError):
        G.find_motif(g, [("a", "b"), ("c", "d")])


def test_hop_property_on_tables(spark):
    """For an edge u->v with v reaching the landmark, hops(u) <= hops(v)+1."""
    gr = T.routes_graph(spark, SF_SMALL)
    hub = T.hub_of(gr)
    hops = {r.id: r.hops for r in G.hops_to_landmarks(gr, hub).collect()}
    for e in gr.edges.collect():
        if e.dst in hops:
            assert e.src in hops and hops[e.src] <= hops[e.dst] + 1


def test_motif_path_and_triangle(spark):
    e = [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "b")]
    g = G.Graph.from_edges(spark.createDataFrame(e, "src string, dst string"))
    tri = {(r.x, r.y, r.z) for r in G.find_motif(g, [("x", "y"), ("y", "z"), ("z", "x")]).collect()}
    assert tri == {("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")}
    # two-step paths x->y->z with no edge back z->y
    paths = {(r.x, r.y, r.z) for r in G.find_motif(g, [("x", "y"), ("y", "z")], [("z", "y")]).collect()}
    assert ("a", "b", "c") in paths and ("a", "b", "d") not in paths


def test_max_hops_bound(g):
    h = {r.id: r.hops for r in G.hops_to_landmarks(g, "DEN", max_hops=2).collect()}
    assert h == {"DEN": 0, "A": 1, "B": 1, "D": 2}


def test_loop_tables_live_under_checkpoint_dir(spark, g):
    from quarry.plans.explain import plan_text
    from quarry.session import ensure_checkpoint_dir

    out = G.hops_to_landmarks(g, "DEN")
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert base in plan_text(out, "formatted")


from collections import deque  # noqa: E402

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _bfs_to(edges, landmark):
    into = {}
    for s, d in edges:
        into.setdefault(d, set()).add(s)
    ids = {x for e in edges for x in e}
    if landmark not in ids:
        return {}
    dist, q = {landmark: 0}, deque([landmark])
    while q:
        v = q.popleft()
        for u in into.get(v, ()):
            if u not in dist:
                dist[u] = dist[v] + 1
                q.append(u)
    return dist


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_hops_equal_python_bfs(spark, edges):
    g = G.Graph.from_edges(spark.createDataFrame(edges, "src long, dst long"))
    got = {(r.id, r.landmark): r.hops for r in G.hops_to_landmarks(g, [0, 1]).collect()}
    want = {(v, lm): d for lm in (0, 1) for v, d in _bfs_to(edges, lm).items()}
    assert got == want


@pytest.mark.parametrize("kw", [{"broadcast_bytes": 0}, {"broadcast_bytes": 0, "partitions": 3}])
def test_hops_join_paths_agree(g, kw):
    h = {r.id: r.hops for r in G.hops_to_landmarks(g, "DEN", **kw).collect()}
    assert h == {"DEN": 0, "A": 1, "B": 1, "D": 2, "E": 3, "F": 4}


def test_landmarks_as_dataframe(spark, g):
    lm = spark.createDataFrame([("DEN",), ("H",), ("nowhere",), ("DEN",)], "landmark string")
    got = {(r.id, r.landmark): r.hops for r in G.hops_to_landmarks(g, lm).collect()}
    assert got[("DEN", "DEN")] == 0 and got[("C", "H")] == 1 and got[("F", "DEN")] == 4
    assert not any(k[1] == "nowhere" for k in got)


def test_motif_returns_edge_attributes(spark):
    e = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 2.0), ("c", "b", 3.0)], "src string, dst string, w double")
    out = G.find_motif(G.Graph.from_edges(e), [("x", "y", "first"), ("y", "z", "second")], [("y", "x")])
    assert [(r.x, r.y, r.z, r.first.w, r.second.w) for r in out.collect()] == [("a", "b", "c", 1.0, 2.0)]


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_graph_tables_filter_before_dedup_in_one_pass(spark):
    routes = spark.range(1000).selectExpr("id % 50 AS s", "id % 70 AS d")
    allowed = spark.range(60)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = G.edges_within(routes, "s", "d", allowed, "id")
        plan = edges._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Aggregate") < plan.index("LeftSemi")
        # Two sides for each join; the dedup finds its rows together.
        assert _exchanges(edges) == 4
        assert _exchanges(G.vertices_of(edges)) == 5
        assert _exchanges(G.graph_counts(G.Graph.from_edges(edges))) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_counts_of_given_vertices(spark):
    e = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    g = G.Graph(spark.range(10), e)
    assert tuple(G.graph_counts(g).first()) == (10, 2)


def test_hops_around_a_vertex_of_very_high_out_degree(spark):
    # "hub" reaches every m, each m reaches L: all candidates of one level are
    # copies of hub.
    edges = [("hub", f"m{i}") for i in range(2000)] + [(f"m{i}", "L") for i in range(2000)] + [("t", "hub")]
    g = G.Graph.from_edges(spark.createDataFrame(edges, "src string, dst string"))
    got = {r.id: r.hops for r in G.hops_to_landmarks(g, "L", broadcast_bytes=0).collect()}
    assert got["hub"] == 2 and got["t"] == 3 and got["m7"] == 1 and len(got) == 2003
    # No table of the search is left in the catalog.
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("quarry_hops")]
