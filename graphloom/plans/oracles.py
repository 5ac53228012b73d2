"""DuckDB SQL that computes what each registered query computes.

The tables are the driver's views.  Shortest costs and paths are a
hop-bounded Bellman-Ford in a recursive CTE (|V| hops are always enough for
non-negative weights); reachability is a recursive UNION (it ends on cycles).
"""
from __future__ import annotations

from graphloom.plans.catalog import HOP_LIMIT, PREVIEW_ROWS
from graphloom.sources.tables import FILL_VALUE, HANDOFF_SOURCE, HOLE_REGION, TRADE_TOP_K

TRADE_V = """trade_v AS (
  SELECT n.n_nationkey::BIGINT AS id, n.n_name AS name, coalesce(cc.value, 0)::BIGINT AS value
  FROM nation n
  LEFT JOIN (SELECT c_nationkey, count(*) AS value FROM customer GROUP BY c_nationkey) cc
    ON cc.c_nationkey = n.n_nationkey)"""

TRADE_E = """trade_e AS (
  SELECT s.s_nationkey::BIGINT AS src, c.c_nationkey::BIGINT AS dst, count(*)::BIGINT AS weight
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)"""

TOP3_E = f"""top3_e AS (
  SELECT src, dst, weight FROM (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC, dst) AS rk
    FROM trade_e WHERE src <> dst) WHERE rk <= {TRADE_TOP_K})"""

HANDOFF_V = "handoff_v AS (SELECT DISTINCT user_id AS id FROM events WHERE user_id IS NOT NULL)"

HANDOFF_E = """handoff_e AS (
  SELECT src, dst, greatest(1, min(gap))::BIGINT AS weight FROM (
    SELECT user_id AS src,
           lead(user_id) OVER w AS dst,
           lead(epoch_us(ts) // 1000000) OVER w - epoch_us(ts) // 1000000 AS gap
    FROM events WHERE ts IS NOT NULL AND event_id IS NOT NULL
    WINDOW w AS (PARTITION BY ts::DATE ORDER BY ts, event_id))
  WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst
  GROUP BY src, dst)"""

TURNS = """turns_c AS (
  SELECT conv_id, turn, conv_id::VARCHAR || ':' || turn::VARCHAR AS id, length(text)::BIGINT AS value,
         turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seg
  FROM conversations),
turns_e AS (
  SELECT a.id AS src, b.id AS dst, b.value AS weight
  FROM turns_c a JOIN turns_c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def _costs(edges: str, vertices: str, source_sql: str, hops: str) -> str:
    """Bellman-Ford cost per vertex (NULL = unreached) over at most ``hops`` edges."""
    return f"""bf(hop, id, dist) AS (
  SELECT 0, s.id, 0::BIGINT FROM ({source_sql}) s
  UNION ALL
  SELECT bf.hop + 1, e.dst, min(bf.dist + e.weight)
  FROM bf JOIN {edges} e ON bf.id = e.src
  WHERE bf.hop < {hops}
  GROUP BY bf.hop + 1, e.dst),
costs AS (
  SELECT v.id, m.dist FROM {vertices} v
  LEFT JOIN (SELECT id, min(dist)::BIGINT AS dist FROM bf GROUP BY id) m ON v.id = m.id)"""


def _paths(edges: str, vertices: str, source_sql: str, hops: str) -> str:
    """Bellman-Ford with (cost, hops, path) order; paths as BIGINT lists."""
    return f"""bf(hop, id, b) AS (
  SELECT 0, s.id, row(0::BIGINT, [s.id]) FROM ({source_sql}) s
  UNION ALL
  SELECT bf.hop + 1, e.dst, min(row(bf.b[1] + e.weight, list_append(bf.b[2], e.dst)))
  FROM bf JOIN {edges} e ON bf.id = e.src
  WHERE bf.hop < {hops}
  GROUP BY bf.hop + 1, e.dst),
best AS (SELECT id, min(row(b[1], hop, b[2])) AS m FROM bf GROUP BY id),
paths AS (
  SELECT v.id, best.m[1]::BIGINT AS dist, best.m[2]::INTEGER AS hops, best.m[3] AS path
  FROM {vertices} v LEFT JOIN best ON v.id = best.id)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


TRADE_SOURCE = "SELECT min(src) AS id FROM trade_e"
TOP3_SOURCE = "SELECT min(src) AS id FROM top3_e"
TRADE_HOPS = "(SELECT count(*) FROM trade_v)"
HANDOFF_HOPS = "(SELECT count(*) FROM handoff_v)"

# Trace of the frontier loop: after round r a vertex holds the best walk of at
# most r edges, so it changes in round r exactly when that best improves; the
# vertices changed in round r - 1 send in round r, one message per out-edge.
TRACE = """steps AS (SELECT range AS r FROM range(0, (SELECT count(*) FROM handoff_v) + 1)),
upto AS (
  SELECT s.r, bf.id, min(row(bf.b[1], bf.hop, bf.b[2])) AS m
  FROM steps s JOIN bf ON bf.hop <= s.r
  GROUP BY s.r, bf.id),
changed AS (
  SELECT cur.r, cur.id FROM upto cur
  LEFT JOIN upto prev ON prev.r = cur.r - 1 AND prev.id = cur.id
  WHERE cur.r >= 1 AND (prev.m IS NULL OR cur.m < prev.m)
  UNION ALL
  SELECT 0, id FROM bf WHERE hop = 0),
quiet AS (
  SELECT min(s.r) AS last FROM steps s
  WHERE s.r >= 1 AND NOT EXISTS (SELECT 1 FROM changed c WHERE c.r = s.r))"""

ORACLES: dict[str, str] = {
    "trade_vertices": _with(TRADE_V) + "SELECT id, name, value FROM trade_v",
    "trade_edges": _with(TRADE_E) + "SELECT src, dst, weight FROM trade_e",
    "handoff_edges": _with(HANDOFF_E) + "SELECT src, dst, weight FROM handoff_e",
    "turns_edges": _with(TURNS) + "SELECT src, dst, weight FROM turns_e",
    "triplets": _with(TRADE_V, TRADE_E)
    + """SELECT e.src, e.dst, e.weight, s.name AS src_name, s.value AS src_value,
       d.name AS dst_name, d.value AS dst_value
FROM trade_e e JOIN trade_v s ON e.src = s.id JOIN trade_v d ON e.dst = d.id""",
    "vertex_fill": _with(
        TRADE_V,
        TRADE_E,
        f"""holes_v AS (
  SELECT v.id, v.name, v.value FROM trade_v v JOIN nation n ON v.id = n.n_nationkey
  WHERE n.n_regionkey <> {HOLE_REGION})""",
    )
    + f"""SELECT id, name, value FROM holes_v
UNION ALL
SELECT x.id, NULL::VARCHAR AS name, {FILL_VALUE}::BIGINT AS value
FROM (SELECT src AS id FROM trade_e UNION SELECT dst FROM trade_e) x
WHERE NOT EXISTS (SELECT 1 FROM holes_v h WHERE h.id = x.id)""",
    "max_reach_trade_top3": _with(
        TRADE_V,
        TRADE_E,
        TOP3_E,
        """reach(a, b) AS (
  SELECT id, id FROM trade_v
  UNION
  SELECT r.a, e.dst FROM reach r JOIN top3_e e ON r.b = e.src)""",
        recursive=True,
    )
    + "SELECT r.b AS id, max(v.value)::BIGINT AS value FROM reach r JOIN trade_v v ON v.id = r.a GROUP BY r.b",
    "max_reach_turns": _with(TURNS)
    + """SELECT id, max(value) OVER (PARTITION BY conv_id, seg ORDER BY turn
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS value
FROM turns_c""",
    "global_max": _with(TRADE_V)
    + """SELECT max(value)::BIGINT AS max_value,
       max(value)::VARCHAR || ' is the maximum value in the graph' AS line
FROM trade_v""",
    "sssp_trade": _with(TRADE_V, TRADE_E, _costs("trade_e", "trade_v", TRADE_SOURCE, TRADE_HOPS), recursive=True)
    + "SELECT id, dist FROM costs",
    "sssp_trade_top3": _with(
        TRADE_V, TRADE_E, TOP3_E, _costs("top3_e", "trade_v", TOP3_SOURCE, TRADE_HOPS), recursive=True
    )
    + "SELECT id, dist FROM costs",
    "sssp_handoff": _with(
        HANDOFF_V,
        HANDOFF_E,
        _costs("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        recursive=True,
    )
    + "SELECT id, dist FROM costs",
    "sssp_turns": _with(TURNS)
    + """SELECT c.id,
       CASE WHEN s.conv_id IS NOT NULL THEN
         (sum(CASE WHEN c.turn = s.turn THEN 0 ELSE c.value END)
            OVER (PARTITION BY c.conv_id, c.seg ORDER BY c.turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT END AS dist
FROM turns_c c
LEFT JOIN (SELECT conv_id, seg, turn FROM turns_c WHERE turn = 0) s
  ON c.conv_id = s.conv_id AND c.seg = s.seg""",
    "sssp_paths_handoff": _with(
        HANDOFF_V,
        HANDOFF_E,
        _paths("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        recursive=True,
    )
    + "SELECT id, dist, hops, array_to_string(path, '>') AS path FROM paths",
    "sssp_hop_limited": _with(
        HANDOFF_V,
        HANDOFF_E,
        _costs("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", str(HOP_LIMIT)),
        recursive=True,
    )
    + "SELECT id, dist FROM costs",
    "sssp_labelled": _with(
        HANDOFF_V,
        HANDOFF_E,
        _costs("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        recursive=True,
    )
    + f"""SELECT p.id, l.c_name AS label, s.c_name AS source_label, p.dist,
       'Minimum cost to get from ' || s.c_name || ' to ' || l.c_name || ' is ' || p.dist::VARCHAR AS line
FROM costs p
LEFT JOIN customer l ON l.c_custkey = p.id
LEFT JOIN customer s ON s.c_custkey = {HANDOFF_SOURCE} AND p.dist IS NOT NULL""",
    "sssp_path_labels": _with(
        HANDOFF_V,
        HANDOFF_E,
        _paths("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        recursive=True,
    )
    + """, named AS (
  SELECT x.id, string_agg(coalesce(n.c_name, x.step::VARCHAR), '>' ORDER BY x.i) AS path_labels
  FROM (SELECT p.id, u.i, p.path[u.i] AS step
        FROM paths p, unnest(range(1, len(p.path) + 1)) AS u(i)
        WHERE p.path IS NOT NULL) x
  LEFT JOIN customer n ON n.c_custkey = x.step
  GROUP BY x.id)
SELECT p.id, p.dist, named.path_labels,
       'Minimum cost to get from ' || s.c_name || ' to ' || l.c_name || ' is ['
         || array_to_string(p.path, ', ') || '] with cost ' || p.dist::VARCHAR AS line
FROM paths p
LEFT JOIN named ON named.id = p.id
LEFT JOIN customer l ON l.c_custkey = p.id
LEFT JOIN customer s ON s.c_custkey = p.path[1]""",
    "superstep_trace": _with(
        HANDOFF_V,
        HANDOFF_E,
        _paths("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        TRACE,
        recursive=True,
    )
    + """SELECT s.r::INTEGER AS superstep,
       (SELECT count(*) FROM changed c WHERE c.r = s.r - 1)::BIGINT AS active,
       (SELECT count(*) FROM changed c JOIN handoff_e e ON e.src = c.id WHERE c.r = s.r - 1)::BIGINT AS messages,
       (SELECT count(DISTINCT e.dst) FROM changed c JOIN handoff_e e ON e.src = c.id
         WHERE c.r = s.r - 1)::BIGINT AS receivers,
       (SELECT count(*) FROM changed c WHERE c.r = s.r)::BIGINT AS changed
FROM steps s JOIN quiet q ON s.r >= 1 AND s.r <= q.last""",
    "reach_back_handoff": _with(
        HANDOFF_V,
        HANDOFF_E,
        "counted AS (SELECT user_id AS id, count(*)::BIGINT AS value FROM events WHERE user_id IS NOT NULL GROUP BY user_id)",
        """reach(a, b) AS (
  SELECT id, id FROM handoff_v
  UNION
  SELECT r.a, e.dst FROM reach r JOIN handoff_e e ON r.b = e.src)""",
        recursive=True,
    )
    + "SELECT r.a AS id, max(c.value)::BIGINT AS value FROM reach r LEFT JOIN counted c ON c.id = r.b GROUP BY r.a",
    "max_component_turns": _with(TURNS)
    + "SELECT id, max(value) OVER (PARTITION BY conv_id, seg)::BIGINT AS value FROM turns_c",
    "handoff_strength": _with(HANDOFF_V, HANDOFF_E)
    + """SELECT v.id, coalesce(sum(x.weight), 0)::BIGINT AS strength FROM handoff_v v
LEFT JOIN (SELECT src AS id, weight FROM handoff_e UNION ALL SELECT dst, weight FROM handoff_e) x ON x.id = v.id
GROUP BY v.id""",
    "walk_counts_trade": _with(
        TRADE_V,
        TRADE_E,
        TOP3_E,
        f"""walk(hop, id, n) AS (
  SELECT 0, id, 1::HUGEINT FROM ({TOP3_SOURCE}) s
  UNION ALL
  SELECT w.hop + 1, e.dst, sum(w.n) FROM walk w JOIN top3_e e ON w.id = e.src
  WHERE w.hop < {HOP_LIMIT} GROUP BY w.hop + 1, e.dst)""",
        recursive=True,
    )
    + """SELECT v.id, coalesce(w.n, 0)::BIGINT AS walks FROM trade_v v
LEFT JOIN (SELECT id, sum(n) AS n FROM walk WHERE hop > 0 GROUP BY id) w ON w.id = v.id""",
    "cost_there_and_back": _with(
        HANDOFF_V,
        HANDOFF_E,
        "back_e AS (SELECT dst AS src, src AS dst, weight FROM handoff_e)",
        _costs("handoff_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS),
        _costs("back_e", "handoff_v", f"SELECT {HANDOFF_SOURCE}::BIGINT AS id", HANDOFF_HOPS)
        .replace("bf", "bb").replace("costs AS", "backs AS"),
        recursive=True,
    )
    + """SELECT c.id, c.dist AS there, b.dist AS back, c.dist + b.dist AS round_trip
FROM costs c JOIN backs b ON b.id = c.id""",
    "named_edges": _with(TRADE_E)
    + """SELECT s.n_name AS src, d.n_name AS dst,
       CASE WHEN s.n_regionkey = d.n_regionkey THEN 'regional' ELSE 'overseas' END AS relationship
FROM trade_e e JOIN nation s ON s.n_nationkey = e.src JOIN nation d ON d.n_nationkey = e.dst""",
    "vertex_dedupe": """SELECT id, customer, name FROM (
  SELECT c_nationkey::BIGINT AS id, c_custkey AS customer, c_name AS name,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, c_name) AS rk FROM customer)
WHERE rk = 1""",
    "edge_preview": _with(HANDOFF_E)
    + f"SELECT src, dst, weight FROM handoff_e ORDER BY src, dst, weight LIMIT {PREVIEW_ROWS}",
}
ORACLES["max_reach_guarded"] = ORACLES["max_reach_turns"]
ORACLES["sssp_guarded_handoff"] = ORACLES["sssp_handoff"]
ORACLES["sssp_signed_turns"] = _with(TURNS) + """SELECT c.id, CASE WHEN s.conv_id IS NOT NULL AND c.turn >= 0 THEN c.value - s.value END AS dist
FROM turns_c c
LEFT JOIN (SELECT conv_id, seg, value FROM turns_c WHERE turn = 0) s ON c.conv_id = s.conv_id AND c.seg = s.seg"""
