"""The query catalogue: every operator applied to the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables (or data Spark derives from them). ``ORACLE_SQL`` holds, for the
SQL-expressible ones, the same query for DuckDB over the same Parquet
tables; column names match one for one.

Mappings of the reference's inputs onto the driver tables:

* routes graph: orders give ``src = o_custkey`` ->
  ``dst = (o_orderkey * 7919) % (number of customers)``; allowed vertices
  are customers outside the HOUSEHOLD segment; the hub / landmark is the
  vertex with most incident edges (lowest id on ties).
* link lines: one text line per order, ``"<cust> <dstA> <dstB> <dstA>"``
  with irregular blanks.
* points: ``id = vec_id`` as a string, ``x, y`` = first two embedding
  components as doubles; threshold 0.02, cell 1/32.
* tags: ``"<event_type>,u<user_id % 3>"``, null for every 7th event id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.ml import dictionary as D
from quarry.operators import cycles as CY
from quarry.operators import graph as G
from quarry.operators import landmarks as LM
from quarry.operators import ranking as R
from quarry.operators import relational as Rel
from quarry.operators import spatial as S
from quarry.operators import trends as T
from quarry.session import cut_lineage, scratch_path
from quarry.sources import csv as CSV
from quarry.sources.parquet import read_table
from quarry.sources.sinks import write_n_files, write_partitioned

# Fixed parameters of the catalogue (the test-table mapping above).
ROUTE_MULTIPLIER = 7919
EXCLUDED_SEGMENT = "HOUSEHOLD"
LINK_MULTIPLIER_B = 31
POINT_THRESHOLD = 0.02
POINT_CELL = 0.03125
TREND_MIN_COUNT = 2
FAR_HOPS = 4
SECOND_LANDMARK = 1
MANY_LANDMARKS = 10
RANK_ROUNDS = 10
RANK_DIGITS = 12
# A page sends its whole rank from each of its (about ten) lines, so the mass
# grows tenfold a round and ranks reach ten million: two decimals are nine digits.
LINE_RANK_DIGITS = 2
PARTITION_VALUE = "Brand#2"
SMALL_PART = 25

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------- relational


def count_where(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return Rel.count_where(c, F.col("c_mktsegment") == "BUILDING", alias="n")


def count_where_sql(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_mktsegment")
    return Rel.count_where_sql(c, "c_mktsegment", "BUILDING", alias="n")


def avg_by_group(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return Rel.avg_by_group(p, "p_brand", "p_size", alias="avg_size", digits=6)


def avg_by_group_sql(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_brand", "p_size")
    return Rel.avg_by_group_sql(p, "p_brand", "p_size", alias="avg_size", digits=6)


def distinct_pairs(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return Rel.distinct_rows(li, ["l_partkey", "l_suppkey"])


def link_join_distinct(spark, sf_dir):
    link = _t(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
    )
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    supp = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return Rel.link_join(link, part, "p_partkey", supp, "s_suppkey").select(
        "p_partkey", "s_suppkey", "p_name", "s_name", "p_brand"
    )


def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "by_brand")
    write_partitioned(link_join_distinct(spark, sf_dir), path, ["p_brand"])
    back = spark.read.schema(
        "p_partkey long, s_suppkey long, p_name string, s_name string, p_brand string"
    ).parquet(path)
    return back.filter(F.col("p_brand") == PARTITION_VALUE).select("p_name", "s_name")


def top_n(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return Rel.top_n(o, 20, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


def _orders_with_gaps(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"),
    )


def drop_incomplete_rows(spark, sf_dir):
    return Rel.drop_incomplete(_orders_with_gaps(spark, sf_dir))


def row_loss(spark, sf_dir):
    return Rel.row_loss(_orders_with_gaps(spark, sf_dir))


# ------------------------------------------------------------- CSV family

PART_DDL = (
    "p_partkey long, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double"
)


def csv_inferred_scan(spark, sf_dir):
    path = scratch_path(spark, "part_csv_hdr")
    _t(spark, sf_dir, "part").write.option("header", "true").csv(path)
    df = CSV.read_csv_inferred(spark, path)
    return df.withColumn("p_partkey", F.col("p_partkey").cast("long"))


def _part_lines_with_faults(spark, sf_dir) -> DataFrame:
    """Part rows as CSV text, some deliberately malformed (derived from the
    row itself): p_size > 45 -> non-numeric size; 1 -> an extra field;
    2 -> a missing field; 3 or 4 -> empty price (well formed, null)."""
    p = _t(spark, sf_dir, "part")
    size_txt = F.when(F.col("p_size") > 45, F.concat(F.lit("s"), F.col("p_size"))).otherwise(
        F.col("p_size").cast("string")
    )
    price_txt = F.when(F.col("p_size").isin(3, 4), F.lit("")).otherwise(
        F.col("p_retailprice").cast("string")
    )
    base = [
        F.col("p_partkey").cast("string"),
        F.col("p_name"),
        F.col("p_brand"),
        F.col("p_type"),
        size_txt,
    ]
    line = (
        F.when(F.col("p_size") == 1, F.concat_ws(",", *base, price_txt, F.lit("extra")))
        .when(F.col("p_size") == 2, F.concat_ws(",", *base))
        .otherwise(F.concat_ws(",", *base, price_txt))
    )
    header_text = ",".join(StructType.fromDDL(PART_DDL).fieldNames())
    header = spark.range(1).select(F.lit(header_text).alias("value"))
    return p.select(line.alias("value")).unionByName(header)


def csv_strict_scan(spark, sf_dir):
    path = scratch_path(spark, "part_csv_strict")
    _part_lines_with_faults(spark, sf_dir).write.text(path)
    return CSV.read_csv_strict(spark, path, PART_DDL, header=True)


CUSTOMER_COLUMNS = {
    "c_custkey": "long",
    "c_name": "string",
    "c_mktsegment": "string",
    "c_nationkey": "int",
}


def csv_typed_clean(spark, sf_dir):
    path = scratch_path(spark, "customer_csv")
    c = _t(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias(
            "c_nationkey"
        ),
        "c_acctbal",
        "c_mktsegment",
    )
    c.write.option("header", "true").csv(path)
    return CSV.read_csv_by_header(spark, path, CUSTOMER_COLUMNS, required=["c_nationkey"])


def csv_multi_file_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "part_csv_20")
    write_n_files(_t(spark, sf_dir, "part"), path, n_files=20, fmt="csv")
    return spark.read.csv(f"{path}/*.csv", schema=PART_DDL, header=False)


def parquet_multi_file_overwrite(spark, sf_dir):
    """Parts as 20 Parquet files; a second write of the cheaper ones replaces
    them all, and the files are read back by a glob."""
    path = scratch_path(spark, "part_parquet_20")
    parts = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    for kept in (parts, parts.filter(F.col("p_size") <= SMALL_PART)):
        write_n_files(kept, path, n_files=20, fmt="parquet", keys=["p_partkey"])
    return spark.read.schema(parts.schema).parquet(f"{path}/*.parquet")


# ------------------------------------------------------------------ graph


def routes_graph(spark, sf_dir) -> G.Graph:
    orders = _t(spark, sf_dir, "orders")
    customer = _t(spark, sf_dir, "customer")
    n_cust = customer.select(F.count(F.lit(1))).scalar()
    routes = orders.select(
        F.col("o_custkey").alias("src"),
        (F.col("o_orderkey") * ROUTE_MULTIPLIER % n_cust).alias("dst"),
    )
    allowed = customer.filter(F.col("c_mktsegment") != EXCLUDED_SEGMENT)
    edges = G.edges_within(routes, "src", "dst", allowed, "c_custkey")
    return G.Graph.from_edges(edges)


def hub_of(g: G.Graph) -> Column:
    """Vertex with most incident edges, lowest id on ties (scalar query)."""
    ends = g.edges.select(F.explode(F.array("src", "dst")).alias("id"))
    deg = ends.groupBy("id").agg(F.count(F.lit(1)).alias("deg"))
    return deg.select(F.min_by("id", F.struct(-F.col("deg"), F.col("id")))).scalar()


def stored_routes_graph(spark, sf_dir) -> G.Graph:
    """The route graph with its edge table written once (for the iterative
    queries, which read it many times: reversed edges, vertices, hub)."""
    return G.Graph.from_edges(cut_lineage(routes_graph(spark, sf_dir).edges, "routes"))


def graph_edges(spark, sf_dir):
    return routes_graph(spark, sf_dir).edges


def graph_vertices(spark, sf_dir):
    return routes_graph(spark, sf_dir).vertices


def graph_counts(spark, sf_dir):
    return G.graph_counts(routes_graph(spark, sf_dir))


def one_way_edges(spark, sf_dir):
    return G.one_way_edges(routes_graph(spark, sf_dir))


def one_way_neighbors(spark, sf_dir):
    g = routes_graph(spark, sf_dir)
    return G.one_way_neighbors(g, hub_of(g))


def hops_to_landmarks(spark, sf_dir):
    g = stored_routes_graph(spark, sf_dir)
    return G.hops_to_landmarks(g, hub_of(g))


def hops_to_two_landmarks(spark, sf_dir):
    """Hops to the hub and to vertex 1, long form."""
    g = stored_routes_graph(spark, sf_dir)
    return G.hops_to_landmarks(g, [hub_of(g), SECOND_LANDMARK])


def hops_resumed(spark, sf_dir):
    """Hops to the hub by a search that is left after two levels and taken up
    from its state folder by a second call."""
    g, state = stored_routes_graph(spark, sf_dir), scratch_path(spark, "hops-state")
    G.hops_to_landmarks(g, hub_of(g), max_hops=2, state=state)
    return G.hops_to_landmarks(g, hub_of(g), state=state)


def hops_to_many_landmarks(spark, sf_dir):
    """Hops to every vertex whose number is divisible by ten, about a hundred
    landmarks, by one search over bits."""
    g = stored_routes_graph(spark, sf_dir)
    marks = g.vertices.filter(F.col("id") % MANY_LANDMARKS == 0).select(F.col("id").alias("landmark"))
    return LM.hops_to_many(g, marks)


def directed_triangles(spark, sf_dir):
    return CY.directed_triangles(stored_routes_graph(spark, sf_dir))


def hops_map(spark, sf_dir):
    g = stored_routes_graph(spark, sf_dir)
    hub = hub_of(g)
    m = G.hops_map(g, G.hops_to_landmarks(g, hub))
    return m.select("id", F.try_element_at("distances", hub).alias("hops"))


def far_from_landmark(spark, sf_dir):
    g = stored_routes_graph(spark, sf_dir)
    hub = hub_of(g)
    return G.far_from_landmark(G.hops_to_landmarks(g, hub), hub, FAR_HOPS)


# ---------------------------------------------------------------- ranking


def link_lines(spark, sf_dir) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    n_cust = _t(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    dst_a = (F.col("o_orderkey") * ROUTE_MULTIPLIER % n_cust).cast("string")
    dst_b = ((F.col("o_orderkey") * LINK_MULTIPLIER_B + F.col("o_custkey")) % n_cust).cast(
        "string"
    )
    text = F.concat(
        F.lit(" "), F.col("o_custkey").cast("string"), F.lit("  "), dst_a, F.lit(" "),
        dst_b, F.lit("\t"), dst_a, F.lit(" "),
    )
    return orders.select(F.col("o_orderkey").alias("line_id"), text.alias("value"))


def link_lists(spark, sf_dir):
    links = R.parse_link_lines(link_lines(spark, sf_dir), "value", line_id_col="line_id")
    return links.select(
        "line_id",
        "page",
        F.size("targets").alias("n_targets"),
        F.array_join("targets", " ").alias("targets"),
    )


def _graph_links(spark, sf_dir) -> DataFrame:
    return R.edges_as_links(routes_graph(spark, sf_dir).edges)


def pagerank_contributions(spark, sf_dir):
    le = _graph_links(spark, sf_dir)
    c = R.contributions(le, R.initial_ranks(le))
    return c.select("page", "target", F.round("contrib", RANK_DIGITS).alias("contrib"))


def pagerank(spark, sf_dir):
    ranks = R.pagerank(_graph_links(spark, sf_dir), iterations=RANK_ROUNDS)
    return ranks.select("page", F.round("rank", RANK_DIGITS).alias("rank"))


def pagerank_dense_ids(spark, sf_dir):
    """The ranks of ``pagerank`` over the customers' names, computed on dense
    numbers and given back by name."""
    names = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    edges = routes_graph(spark, sf_dir).edges
    for end in ("src", "dst"):
        edges = edges.join(names.toDF(end, f"{end}_name"), end)
    named = cut_lineage(edges.select(F.col("src_name").alias("src"), F.col("dst_name").alias("dst")), "named-routes")
    g, words = G.dense_ids(G.Graph.from_edges(named))
    ranks = R.pagerank(R.edges_as_links(g.edges), iterations=RANK_ROUNDS)
    back = D.decode(ranks, "page", words, "name")
    return back.select("name", F.round("rank", RANK_DIGITS).alias("rank"))


def pagerank_resumed(spark, sf_dir):
    """The ranks of ``pagerank`` from a loop that is left after four rounds and
    taken up from its state folder by a second call."""
    links, state = cut_lineage(_graph_links(spark, sf_dir), "rank-links"), scratch_path(spark, "rank-state")
    R.pagerank(links, iterations=4, checkpoint_every=2, state=state)
    ranks = R.pagerank(links, iterations=RANK_ROUNDS, checkpoint_every=2, state=state)
    return ranks.select("page", F.round("rank", RANK_DIGITS).alias("rank"))


def pagerank_lines(spark, sf_dir):
    """Ranks straight from text link lines, one line per order: a
    customer owning several lines contributes from each of them."""
    links = R.parse_link_lines(link_lines(spark, sf_dir), "value", line_id_col="line_id")
    ranks = R.pagerank(R.link_edges(links), iterations=RANK_ROUNDS, pages=links.select("page"))
    return ranks.select("page", F.round("rank", LINE_RANK_DIGITS).alias("rank"))


# ---------------------------------------------------------------- spatial


def points(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("string").alias("id"),
        F.get("embedding", 0).cast("double").alias("x"),
        F.get("embedding", 1).cast("double").alias("y"),
    )


def grid_cells(spark, sf_dir):
    return S.grid_cells(points(spark, sf_dir), POINT_CELL)


def grid_push(spark, sf_dir):
    return S.grid_push(S.grid_cells(points(spark, sf_dir), POINT_CELL))


def close_pairs(spark, sf_dir):
    return S.close_pairs(points(spark, sf_dir), POINT_THRESHOLD)


def close_pair_count(spark, sf_dir):
    return S.close_pair_count(close_pairs(spark, sf_dir))


# ----------------------------------------------------------------- trends


def tagged_events(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    tags = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(",", F.col("event_type"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")))
    )
    return ev.select("event_id", "ts", tags.alias("tags"))


def explode_tags(spark, sf_dir):
    return T.explode_tags(tagged_events(spark, sf_dir), "tags", keep=["event_id", "ts"], tag_alias="tag")


def sliding_tag_counts(spark, sf_dir):
    tagged = explode_tags(spark, sf_dir)
    counts = T.windowed_counts(tagged, "ts", "tag", "60 minutes", "30 minutes", "tag_count")
    return T.flatten_window(counts)


def sliding_tag_counts_panes(spark, sf_dir):
    """The counts of ``sliding_tag_counts`` by way of panes."""
    counts = T.pane_counts(explode_tags(spark, sf_dir), "ts", "tag", "60 minutes", "30 minutes", "tag_count")
    return T.flatten_window(counts)


def trending_tags(spark, sf_dir):
    ev = tagged_events(spark, sf_dir).withColumnRenamed("tags", "tag")
    return T.trending_tags(ev, "ts", "tag", TREND_MIN_COUNT, count_alias="tag_count")


QUERIES: dict[str, QueryFn] = {
    "count_where": count_where,
    "count_where_sql": count_where_sql,
    "avg_by_group": avg_by_group,
    "avg_by_group_sql": avg_by_group_sql,
    "distinct_pairs": distinct_pairs,
    "link_join_distinct": link_join_distinct,
    "partitioned_roundtrip": partitioned_roundtrip,
    "top_n": top_n,
    "drop_incomplete_rows": drop_incomplete_rows,
    "row_loss": row_loss,
    "csv_inferred_scan": csv_inferred_scan,
    "csv_strict_scan": csv_strict_scan,
    "csv_typed_clean": csv_typed_clean,
    "csv_multi_file_roundtrip": csv_multi_file_roundtrip,
    "parquet_multi_file_overwrite": parquet_multi_file_overwrite,
    "graph_edges": graph_edges,
    "graph_vertices": graph_vertices,
    "graph_counts": graph_counts,
    "one_way_edges": one_way_edges,
    "one_way_neighbors": one_way_neighbors,
    "hops_to_landmarks": hops_to_landmarks,
    "hops_to_two_landmarks": hops_to_two_landmarks,
    "hops_resumed": hops_resumed,
    "hops_to_many_landmarks": hops_to_many_landmarks,
    "directed_triangles": directed_triangles,
    "hops_map": hops_map,
    "far_from_landmark": far_from_landmark,
    "link_lists": link_lists,
    "pagerank_contributions": pagerank_contributions,
    "pagerank": pagerank,
    "pagerank_resumed": pagerank_resumed,
    "pagerank_dense_ids": pagerank_dense_ids,
    "pagerank_lines": pagerank_lines,
    "grid_cells": grid_cells,
    "grid_push": grid_push,
    "close_pairs": close_pairs,
    "close_pair_count": close_pair_count,
    "explode_tags": explode_tags,
    "sliding_tag_counts": sliding_tag_counts,
    "sliding_tag_counts_panes": sliding_tag_counts_panes,
    "trending_tags": trending_tags,
}
