"""Directed-graph operators on two DataFrames: ``vertices(id)`` and
``edges(src, dst)``.

* edges from a route table restricted to an allowed vertex set (semi joins)
* vertex set = every id seen as src or dst
* motif search with positive and negated edge terms (joins / anti joins)
* one-way neighbours of a hub
* hop counts from every vertex *to* a set of landmarks (breadth-first over
  reversed edges, one distributed job per level, lineage cut by reliable
  checkpoints in ``spark.checkpoint.dir``)
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.ml.dictionary import Dictionary, build_dictionary, encode
from quarry.operators.rounds import Rounds
from quarry.operators.skew import hot_slices


@dataclass(frozen=True)
class Graph:
    """Vertex and edge tables with the ``id`` / ``src``,``dst`` contract."""

    vertices: DataFrame
    edges: DataFrame
    derived: bool = False  # the vertices are the edges' ends

    @staticmethod
    def from_edges(edges: DataFrame) -> "Graph":
        return Graph(vertices_of(edges), edges, derived=True)


def edges_within(
    routes: DataFrame,
    src_col: str,
    dst_col: str,
    allowed: DataFrame,
    allowed_id: str,
) -> DataFrame:
    """Distinct directed ``(src, dst)`` routes whose both ends are in
    ``allowed``.

    Two left-semi joins, then the de-duplication: excluded routes never reach
    its shuffle, an id listed twice in ``allowed`` cannot multiply edges, and
    only the two route columns travel.
    """
    ids = allowed.select(F.col(allowed_id).alias("_vid"))
    pairs = routes.select(F.col(src_col).alias("src"), F.col(dst_col).alias("dst"))
    inside = pairs.join(ids, pairs.src == ids._vid, "left_semi").join(
        ids, pairs.dst == ids._vid, "left_semi"
    )
    return inside.distinct()


def vertices_of(edges: DataFrame) -> DataFrame:
    """Every id that occurs as a source or a destination, in one pass over
    the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def graph_counts(g: Graph) -> DataFrame:
    """One row: ``n_vertices``, ``n_edges``. Where the vertices are the
    edges' ends, both come from one pass over the edges."""
    if not g.derived:
        return g.edges.sparkSession.range(1).select(
            g.vertices.select(F.count(F.lit(1))).scalar().alias("n_vertices"),
            g.edges.select(F.count(F.lit(1))).scalar().alias("n_edges"),
        )
    end = lambda name, starts: F.struct(F.col(name).alias("id"), F.lit(starts).alias("starts"))
    ends = g.edges.select(F.explode(F.array(end("src", 1), end("dst", 0))).alias("e"))
    per_vertex = ends.groupBy("e.id").agg(F.sum("e.starts").alias("starts"))
    return per_vertex.agg(
        F.count(F.lit(1)).alias("n_vertices"), F.coalesce(F.sum("starts"), F.lit(0)).alias("n_edges")
    )


def find_motif(
    g: Graph,
    positive: Sequence[tuple[str, ...]],
    negative: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Match a motif given as edge terms over named vertices.

    ``positive`` terms ``(u, v)`` require an edge u->v (inner joins on the
    endpoints already bound); a third name ``(u, v, e)`` also returns the
    matched edge as a struct column ``e`` with all its attributes.
    ``negative`` terms require that no edge u->v exists (left-anti joins;
    both ends must be bound by positive terms). Returns one column per vertex
    name, holding the vertex id, and one per edge name.
    """
    if not positive:
        raise ValueError("a motif needs at least one positive edge term")

    def term(u: str, v: str, name: str | None = None) -> DataFrame:
        edges = g.edges.filter(F.col("src") == F.col("dst")) if u == v else g.edges
        ends = [F.col("src").alias(u)] + ([F.col("dst").alias(v)] if u != v else [])
        return edges.select(*ends, *([F.struct(*g.edges.columns).alias(name)] if name else []))

    out = term(*positive[0])
    bound = set(positive[0][:2])
    for t in positive[1:]:
        u, v = t[:2]
        keys = [n for n in dict.fromkeys((u, v)) if n in bound]
        if not keys:
            # A term sharing no vertex with the pattern so far would need a
            # cross product; such motifs are rejected.
            raise ValueError(f"term ({u})->({v}) is not connected to the motif")
        out = out.join(term(*t), keys, "inner")
        bound |= {u, v}
    for u, v in negative:
        if u not in bound or v not in bound:
            raise ValueError(f"negated term ({u})->({v}) uses an unbound vertex")
        rev = g.edges.select(F.col("src").alias("_nu"), F.col("dst").alias("_nv"))
        out = out.join(
            rev, (out[u] == rev["_nu"]) & (out[v] == rev["_nv"]), "left_anti"
        )
    return out


def dense_ids(g: Graph, path: str | None = None) -> tuple[Graph, Dictionary]:
    """The graph with its vertices numbered from 0 in the order of their ids,
    and the dictionary behind the numbers: loops then join and shuffle eight
    bytes instead of long names. ``ml.dictionary.decode`` gives the ids back."""
    names = build_dictionary(g.vertices.select("id").distinct(), "id", path)
    edges = encode(encode(g.edges.select("src", "dst"), "src", names, "from"), "dst", names, "to")
    return Graph.from_edges(edges.select(F.col("from").alias("src"), F.col("to").alias("dst"))), names


def one_way_edges(g: Graph) -> DataFrame:
    """Edges ``a -> b`` with no edge ``b -> a`` (self-loops never qualify)."""
    return find_motif(g, [("a", "b")], [("b", "a")])


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def one_way_neighbors(g: Graph, hub, alias: str = "id") -> DataFrame:
    """Vertices joined to ``hub`` by an edge in one direction only.

    ``hub`` is a literal id or a Column (e.g. a scalar sub-query). The hub
    predicate is pushed below the anti join by the optimizer.
    """
    h = _as_col(hub)
    m = one_way_edges(g).filter(
        ((F.col("a") == h) | (F.col("b") == h)) & ((F.col("a") != h) | (F.col("b") != h))
    )
    return m.select(F.when(F.col("b") == h, F.col("a")).otherwise(F.col("b")).alias(alias))


def _landmark_frame(g: Graph, landmarks) -> DataFrame:
    """Landmarks (literals, a Column, or a DataFrame with ``landmark``)
    restricted to ids present in the vertex table.

    The vertex table is on the probe side in both forms, so the optimizer
    applies the landmark predicate (or semi join) before its distinct instead
    of de-duplicating every vertex first.
    """
    if isinstance(landmarks, DataFrame):
        lm = landmarks.select("landmark").distinct()
        found = g.vertices.join(lm, g.vertices["id"] == lm["landmark"], "left_semi")
    else:
        items: Iterable = (
            [landmarks] if isinstance(landmarks, (Column, str, int)) else landmarks
        )
        cond = F.lit(False)
        for item in items:
            cond = cond | (F.col("id") == _as_col(item))
        found = g.vertices.filter(cond)
    return found.select(F.col("id").alias("landmark"))


def _held_bytes(pairs: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``(id, landmark)`` pairs, measured."""
    size = F.sum(sum((F.octet_length(F.col(c).cast("string")) + 16 for c in ("id", "landmark")), F.lit(0)))
    return tuple(pairs.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first())


class _Visited:
    """The pairs of the levels so far, for anti joins that don't move them.

    Levels that are small in sum (``limit`` bytes, measured) are broadcast.
    What goes beyond that is written once more, bucketed on ``(id, landmark)``:
    candidates that are de-duplicated already have that partitioning."""

    def __init__(self, spark, rounds: Rounds, buckets: int, limit: int):
        self.spark, self.rounds, self.buckets, self.limit = spark, rounds, buckets, limit
        self.small: list[DataFrame] = []
        self.held, self.tables = 0, []

    def add(self, pairs: DataFrame, held: int, level: int) -> None:
        self.small.append(pairs.select("id", "landmark"))
        self.held += held
        if self.held <= self.limit:
            return
        step, table = f"visited-{level}", f"quarry_visited_{uuid.uuid4().hex}"
        path, rows = f"{self.rounds.path}/{step}", self._union()
        if self.rounds.whole(step):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (id, landmark) SORTED BY (id, landmark) "
                f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        else:
            (
                rows.repartition(self.buckets, "id", "landmark").write.mode("overwrite").format("parquet")
                .bucketBy(self.buckets, "id", "landmark").sortBy("id", "landmark").option("path", path).saveAsTable(table)
            )
        self.tables.append(table)
        self.small, self.held = [], 0

    def _union(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.small)

    def new(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct ``pairs`` that no level has."""
        for table in self.tables:
            pairs = pairs.join(self.spark.table(table), ["id", "landmark"], "left_anti")
        return pairs.join(F.broadcast(self._union()), ["id", "landmark"], "left_anti") if self.small else pairs

    def drop(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # its files stay at the path


def hops_to_landmarks(
    g: Graph,
    landmarks,
    max_hops: int | None = None,
    broadcast_bytes: int = 8 << 20,
    partitions: int | None = None,
    state: str | None = None,
) -> DataFrame:
    """Fewest edges on a directed path from each vertex to each landmark.

    Long form ``(id, landmark, hops)``; the landmark itself has 0 and
    vertices that cannot reach a landmark have no row for it.

    Breadth-first search over reversed edges, one distributed job per level:

    * The reversed edges are hash-partitioned on the target once, a hub's
      edges over several slices (``operators.skew``). A frontier whose
      measured size is at most ``broadcast_bytes`` is broadcast; a larger one
      is moved to the edges' partitions.
    * Candidates are de-duplicated first, with map-side reduction: many edges
      into one new vertex cost one row per task.
    * A level is a table of its own, read alone as the next frontier, in as
      few files as its rows need. The visited pairs are anti-joined without
      being moved (:class:`_Visited`).

    The tables lie under the shared checkpoint directory: a lost executor
    costs at most one level. With ``state``, a folder, they stay there, and a
    call on the same folder and input goes on after the last level that was
    written. Stops when a level is empty (or after ``max_hops`` levels).
    """
    spark = g.edges.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    start = _landmark_frame(g, landmarks).select(
        F.col("landmark").alias("id"), "landmark", F.lit(0).alias("hops")
    )
    rounds = Rounds(spark, state, "hops", [g.edges, start], partitions=n_parts, limit=broadcast_bytes)
    reversed_edges = rounds.keep(
        "reversed", lambda: g.edges.select(F.col("dst").alias("id"), F.col("src").alias("prev")).distinct()
    )
    hubs = hot_slices(reversed_edges, "id", n_parts, lambda df, name: rounds.keep(name, lambda: df))
    rev = hubs.spread(reversed_edges, "prev").repartition(n_parts, "id", "salt").persist()
    visited = _Visited(spark, rounds, n_parts, broadcast_bytes)

    def next_level(frontier: DataFrame, held: int, level: int) -> DataFrame:
        around = hubs.repeat(frontier.select("id", "landmark"))
        if held <= broadcast_bytes:
            around = F.broadcast(around)
        reached = around.join(rev, ["id", "salt"]).select(F.col("prev").alias("id"), "landmark").distinct()
        return visited.new(reached).withColumn("hops", F.lit(level))

    levels = [rounds.keep("level-0", lambda: start)]
    try:
        while max_hops is None or len(levels) <= max_hops:
            frontier, level = levels[-1], len(levels)
            rows, held = _held_bytes(frontier)
            if not rows:
                break
            visited.add(frontier, held, level - 1)
            levels.append(rounds.keep(f"level-{level}", lambda f=frontier, h=held, n=level: next_level(f, h, n)))
    finally:
        rev.unpersist()
        visited.drop()
    paths = [f"{rounds.path}/level-{i}" for i in range(len(levels))]
    return spark.read.schema(start.schema).parquet(*paths)


def hops_map(g: Graph, hops: DataFrame) -> DataFrame:
    """Every vertex with a ``distances`` map landmark -> hops (empty when no
    landmark is reachable). The map per vertex is bounded by the number of
    landmarks."""
    per_vertex = hops.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("landmark", "hops"))).alias(
            "distances"
        )
    )
    empty = F.create_map().cast(per_vertex.schema["distances"].dataType)
    return g.vertices.join(per_vertex, "id", "left").select(
        "id", F.coalesce(F.col("distances"), empty).alias("distances")
    )


def far_from_landmark(
    hops: DataFrame, landmark, min_hops: int = 4, alias: str = "hops"
) -> DataFrame:
    """Vertices at least ``min_hops`` edges away from ``landmark``, ordered
    by hops then id. Unreachable vertices have no distance and are left out."""
    return (
        hops.filter((F.col("landmark") == _as_col(landmark)) & (F.col("hops") >= min_hops))
        .select("id", F.col("hops").alias(alias))
        .orderBy(alias, "id")
    )
