"""DuckDB SQL twins of the catalogue in ``quarry.plans.tables``.

Tables are the driver's views (region, nation, customer, ..., events).
Every computed column carries the same alias as the Spark result.
"""

from __future__ import annotations

# Shared CTE bodies --------------------------------------------------------

_GRAPH = """
routes AS (
  SELECT o_custkey AS src, (o_orderkey * 7919) % (SELECT COUNT(*) FROM customer) AS dst
  FROM orders
),
allowed AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
edges AS (
  SELECT DISTINCT src, dst FROM routes
  WHERE src IN (SELECT id FROM allowed) AND dst IN (SELECT id FROM allowed)
),
vertices AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
deg AS (
  SELECT id, COUNT(*) AS d FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges)
  GROUP BY id
),
hub AS (SELECT id FROM deg ORDER BY d DESC, id LIMIT 1)
"""

# Breadth-first search: one row per (vertex, landmark), so the recursion ends
# when a level finds nothing new.
_BFS = """
bfs(id, landmark, hops) USING KEY (id, landmark) AS (
  SELECT id, id, 0 FROM {landmarks}
  UNION
  SELECT e.src, b.landmark, MIN(b.hops) + 1
  FROM bfs b JOIN edges e ON e.dst = b.id
  LEFT JOIN recurring.bfs r ON r.id = e.src AND r.landmark = b.landmark
  WHERE r.id IS NULL GROUP BY e.src, b.landmark
),
hops AS (SELECT id, landmark, CAST(hops AS INTEGER) AS hops FROM bfs)
"""
_HOPS = _BFS.format(landmarks="hub")
_TWO_HOPS = _BFS.format(
    landmarks="(SELECT id FROM hub UNION SELECT id FROM vertices WHERE id = 1)"
)

_LINKS = """
gl AS (
  SELECT e.src AS page, e.dst AS target, d.n AS n_targets
  FROM edges e JOIN (SELECT src, COUNT(*) AS n FROM edges GROUP BY src) d ON e.src = d.src
),
r0 AS (
  SELECT DISTINCT page, 1.0::DOUBLE / (SELECT COUNT(DISTINCT page) FROM gl) AS rank FROM gl
)
"""


def _rank_rounds(n: int, edges: str = "gl") -> str:
    parts = []
    for i in range(1, n + 1):
        parts.append(
            f"r{i} AS (SELECT {edges}.target AS page, SUM(r{i-1}.rank / {edges}.n_targets) "
            f"AS rank FROM {edges} JOIN r{i-1} ON {edges}.page = r{i-1}.page "
            f"GROUP BY {edges}.target)"
        )
    return ",\n".join(parts)


_POINTS = """
pts AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding[1] AS DOUBLE) AS x,
         CAST(embedding[2] AS DOUBLE) AS y
  FROM embeddings
)
"""

_CLOSE = (
    "WITH "
    + _POINTS
    + """,
rp AS (SELECT ROW_NUMBER() OVER () AS rid, id, x, y FROM pts)
SELECT DISTINCT LEAST(a.id, b.id) AS id_a, GREATEST(a.id, b.id) AS id_b
FROM rp a JOIN rp b ON a.rid < b.rid
WHERE SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.02
"""
)

_TAGS = """
tagged AS (
  SELECT event_id, ts,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE event_type || ',u' || CAST(user_id % 3 AS VARCHAR) END AS tags
  FROM events
),
exploded AS (
  SELECT event_id, ts, UNNEST(STRING_SPLIT(tags, ',')) AS tag FROM tagged
  WHERE tags IS NOT NULL
),
wcounts AS (
  SELECT TIME_BUCKET(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS window_start,
         TIME_BUCKET(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE + INTERVAL 60 MINUTE
           AS window_end,
         tag, COUNT(*) AS tag_count
  FROM exploded, (VALUES (0), (1)) AS o(k)
  WHERE ts IS NOT NULL
  GROUP BY ALL
)
"""

_GAPS = """
g AS (
  SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
         NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders
)
"""

_LINES = """
lines AS (
  SELECT o_orderkey AS line_id,
         REGEXP_SPLIT_TO_ARRAY(TRIM(
           CAST(o_custkey AS VARCHAR) || ' ' ||
           CAST((o_orderkey * 7919) % (SELECT COUNT(*) FROM customer) AS VARCHAR) || ' ' ||
           CAST((o_orderkey * 31 + o_custkey) % (SELECT COUNT(*) FROM customer) AS VARCHAR) || ' ' ||
           CAST((o_orderkey * 7919) % (SELECT COUNT(*) FROM customer) AS VARCHAR)), '\\s+') AS w
  FROM orders
)
"""

_LINE_RANKS = """
le AS (
  SELECT page, UNNEST(t) AS target, LEN(t) AS n_targets
  FROM (SELECT w[1] AS page, LIST_DISTINCT(w[2:]) AS t FROM lines)
),
r0 AS (
  SELECT DISTINCT w[1] AS page,
         1.0::DOUBLE / (SELECT COUNT(DISTINCT w[1]) FROM lines) AS rank
  FROM lines
)
"""

ORACLE_SQL: dict[str, str] = {
    "count_where": "SELECT COUNT(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'",
    "count_where_sql": "SELECT COUNT(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'",
    "avg_by_group": (
        "SELECT p_brand, ROUND(AVG(p_size), 6) AS avg_size FROM part GROUP BY p_brand "
        "ORDER BY avg_size DESC, p_brand"
    ),
    "avg_by_group_sql": (
        "SELECT p_brand, ROUND(AVG(p_size), 6) AS avg_size FROM part GROUP BY p_brand "
        "ORDER BY avg_size DESC, p_brand"
    ),
    "distinct_pairs": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "link_join_distinct": (
        "SELECT DISTINCT p.p_partkey, s.s_suppkey, p.p_name, s.s_name, p.p_brand "
        "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey "
        "JOIN supplier s ON l.l_suppkey = s.s_suppkey"
    ),
    "partitioned_roundtrip": (
        "SELECT p_name, s_name FROM (SELECT DISTINCT p.p_partkey, s.s_suppkey, p.p_name, "
        "s.s_name, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey "
        "JOIN supplier s ON l.l_suppkey = s.s_suppkey) WHERE p_brand = 'Brand#2'"
    ),
    "top_n": (
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
    ),
    "drop_incomplete_rows": (
        "WITH " + _GAPS + " SELECT * FROM g "
        "WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL"
    ),
    "row_loss": (
        "WITH " + _GAPS + ", c AS (SELECT COUNT(*) AS n_before, "
        "COUNT(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL) "
        "AS n_after FROM g) SELECT n_before, n_after, "
        "ROUND((n_before - n_after) / n_before * 100.0, 6) AS loss_pct FROM c"
    ),
    "csv_inferred_scan": "SELECT * FROM part",
    "csv_strict_scan": (
        "SELECT p_partkey, p_name, p_brand, p_type, p_size, "
        "CASE WHEN p_size IN (3, 4) THEN NULL ELSE p_retailprice END AS p_retailprice "
        "FROM part WHERE p_size <= 45 AND p_size NOT IN (1, 2)"
    ),
    "csv_typed_clean": (
        "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer "
        "WHERE c_acctbal >= 0"
    ),
    "csv_multi_file_roundtrip": "SELECT * FROM part",
    "graph_edges": "WITH " + _GRAPH + " SELECT src, dst FROM edges",
    "graph_vertices": "WITH " + _GRAPH + " SELECT id FROM vertices",
    "graph_counts": (
        "WITH " + _GRAPH + " SELECT (SELECT COUNT(*) FROM vertices) AS n_vertices, "
        "(SELECT COUNT(*) FROM edges) AS n_edges"
    ),
    "one_way_edges": (
        "WITH " + _GRAPH + " SELECT e.src AS a, e.dst AS b FROM edges e "
        "WHERE NOT EXISTS (SELECT 1 FROM edges r WHERE r.src = e.dst AND r.dst = e.src)"
    ),
    "one_way_neighbors": (
        "WITH " + _GRAPH + " SELECT CASE WHEN e.dst = (SELECT id FROM hub) THEN e.src "
        "ELSE e.dst END AS id FROM edges e "
        "WHERE NOT EXISTS (SELECT 1 FROM edges r WHERE r.src = e.dst AND r.dst = e.src) "
        "AND (e.src = (SELECT id FROM hub) OR e.dst = (SELECT id FROM hub)) "
        "AND (e.src <> (SELECT id FROM hub) OR e.dst <> (SELECT id FROM hub))"
    ),
    "hops_to_landmarks": "WITH RECURSIVE " + _GRAPH + "," + _HOPS + " SELECT * FROM hops",
    "hops_to_two_landmarks": "WITH RECURSIVE " + _GRAPH + "," + _TWO_HOPS + " SELECT * FROM hops",
    "hops_map": (
        "WITH RECURSIVE " + _GRAPH + "," + _HOPS + " SELECT v.id, h.hops FROM vertices v "
        "LEFT JOIN hops h ON v.id = h.id"
    ),
    "far_from_landmark": (
        "WITH RECURSIVE " + _GRAPH + "," + _HOPS + " SELECT id, hops FROM hops "
        "WHERE hops >= 4 ORDER BY hops, id"
    ),
    "link_lists": (
        "WITH " + _LINES + " SELECT line_id, w[1] AS page, "
        "CAST(LEN(LIST_DISTINCT(w[2:])) AS INTEGER) AS n_targets, "
        "ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(w[2:])), ' ') AS targets FROM lines"
    ),
    "pagerank_contributions": (
        "WITH " + _GRAPH + "," + _LINKS + " SELECT gl.page, gl.target, "
        "ROUND(r0.rank / gl.n_targets, 12) AS contrib FROM gl JOIN r0 ON gl.page = r0.page"
    ),
    "pagerank": (
        "WITH " + _GRAPH + "," + _LINKS + "," + _rank_rounds(10)
        + " SELECT page, ROUND(rank, 12) AS rank FROM r10 ORDER BY rank DESC, page"
    ),
    "pagerank_lines": (
        "WITH " + _LINES + "," + _LINE_RANKS + "," + _rank_rounds(10, "le")
        + " SELECT page, ROUND(rank, 2) AS rank FROM r10 ORDER BY rank DESC, page"
    ),
    "grid_cells": (
        "WITH " + _POINTS + " SELECT CAST(FLOOR(x / 0.03125) AS BIGINT) AS cx, "
        "CAST(FLOOR(y / 0.03125) AS BIGINT) AS cy, id, x, y FROM pts"
    ),
    "grid_push": (
        "WITH " + _POINTS + ", c AS (SELECT CAST(FLOOR(x / 0.03125) AS BIGINT) AS cx, "
        "CAST(FLOOR(y / 0.03125) AS BIGINT) AS cy, id, x, y FROM pts) "
        "SELECT cx + dx AS cx, cy + dy AS cy, id, x, y, (dx = 0 AND dy = 0) AS home "
        "FROM c, (VALUES (0, 0), (0, 1), (1, 1), (1, 0), (1, -1)) AS o(dx, dy)"
    ),
    "close_pairs": _CLOSE,
    "close_pair_count": "SELECT COUNT(*) AS n_pairs FROM (" + _CLOSE + ")",
    "explode_tags": "WITH " + _TAGS + " SELECT event_id, ts, tag FROM exploded",
    "sliding_tag_counts": (
        "WITH " + _TAGS + " SELECT window_start, window_end, tag, tag_count FROM wcounts"
    ),
    "trending_tags": (
        "WITH " + _TAGS + " SELECT window_start, window_end, tag, tag_count FROM wcounts "
        "WHERE tag_count > 2 ORDER BY window_start, tag_count DESC, tag"
    ),
}
ORACLE_SQL["hops_resumed"] = ORACLE_SQL["hops_to_landmarks"]
ORACLE_SQL["pagerank_resumed"] = ORACLE_SQL["pagerank"]
ORACLE_SQL["sliding_tag_counts_panes"] = ORACLE_SQL["sliding_tag_counts"]
ORACLE_SQL["parquet_multi_file_overwrite"] = "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size <= 25"
ORACLE_SQL["hops_to_many_landmarks"] = (
    "WITH RECURSIVE " + _GRAPH + "," + _BFS.format(landmarks="(SELECT id FROM vertices WHERE id % 10 = 0)") + " SELECT * FROM hops"
)
ORACLE_SQL["directed_triangles"] = (
    "WITH " + _GRAPH + " SELECT e1.src AS a, e2.src AS b, e3.src AS c FROM edges e1 JOIN edges e2 ON e1.dst = e2.src "
    "JOIN edges e3 ON e2.dst = e3.src AND e3.dst = e1.src WHERE e1.src < e2.src AND e1.src < e3.src AND e2.src <> e3.src"
)
ORACLE_SQL["pagerank_dense_ids"] = (
    "WITH " + _GRAPH + "," + _LINKS + "," + _rank_rounds(10)
    + " SELECT c_name AS name, ROUND(rank, 12) AS rank FROM r10 JOIN customer ON page = c_custkey"
)
