"""Closed motifs: directed triangles by degree-ordered edges.

A plain join of a cyclic motif makes every wedge at a hub, the square of its
degree. Here each pair of neighbours is one edge that goes from the vertex of
smaller degree (ties: smaller id) to the other, with the directions it has in
the graph. A vertex then has at most ``sqrt(2 m)`` outgoing edges, so wedges
number ``m ** 1.5`` at most, and a hub, to which all edges lead, makes none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.graph import Graph
from quarry.session import cut_lineage

TO, FRO = 1, 2  # the directions that a pair of neighbours has


def ordered_edges(g: Graph) -> DataFrame:
    """``(u, v, rank, ways)``: pairs of neighbours from the smaller (degree,
    id) ``u`` to the larger ``v``, whose (degree, id) is ``rank``; ``ways`` has
    TO for an edge u -> v and FRO for v -> u. Loops are left out."""
    pairs = (
        g.edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.when(F.col("src") < F.col("dst"), TO).otherwise(FRO).alias("way"))
        .groupBy("a", "b").agg(F.bit_or("way").alias("ways"))
    )
    pairs = cut_lineage(pairs, "neighbour-pairs")
    degrees = cut_lineage(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree")), "degrees"
    )
    of_a = degrees.select(F.col("id").alias("a"), F.struct("degree", "id").alias("ra"))
    of_b = degrees.select(F.col("id").alias("b"), F.struct("degree", "id").alias("rb"))
    both = pairs.join(of_a, "a").join(of_b, "b")
    turned = F.when(F.col("ways") == TO, FRO).when(F.col("ways") == FRO, TO).otherwise(F.col("ways"))
    up = F.col("ra") < F.col("rb")
    return both.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("v"),
        F.greatest("ra", "rb").alias("rank"), F.when(up, F.col("ways")).otherwise(turned).alias("ways"),
    )


def wedges(edges: DataFrame) -> DataFrame:
    """``(u, v, w, uv, uw)``: two outgoing edges of ``u``, v before w."""
    first = edges.select("u", "v", F.col("rank").alias("rv"), F.col("ways").alias("uv"))
    second = edges.select("u", F.col("v").alias("w"), F.col("rank").alias("rw"), F.col("ways").alias("uw"))
    return first.join(second, "u").where(F.col("rv") < F.col("rw")).select("u", "v", "w", "uv", "uw")


def directed_triangles(g: Graph) -> DataFrame:
    """``(a, b, c)`` with edges a -> b -> c -> a, each circle once, from its
    smallest vertex; a -> b -> c and a -> c -> b are two circles."""
    edges = cut_lineage(ordered_edges(g), "ordered-edges")
    closing = edges.select(F.col("u").alias("v"), F.col("v").alias("w"), F.col("ways").alias("vw"))
    closed = wedges(edges).join(closing, ["v", "w"])
    has = lambda ways, way: F.col(ways).bitwiseAND(way) != 0
    circle = lambda x, y, z: F.array(F.col(x), F.col(y), F.col(z))
    circles = F.filter(
        F.array(
            F.when(has("uv", TO) & has("vw", TO) & has("uw", FRO), circle("u", "v", "w")),
            F.when(has("uw", TO) & has("vw", FRO) & has("uv", FRO), circle("u", "w", "v")),
        ),
        lambda c: c.isNotNull(),
    )
    found = closed.select(F.explode(circles).alias("c"))
    start = F.array_position("c", F.array_min("c")).cast("int") - 1
    turn = lambda i: F.get("c", (start + i) % 3)
    return found.select(turn(0).alias("a"), turn(1).alias("b"), turn(2).alias("c"))
