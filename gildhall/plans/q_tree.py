"""Organisation tree paths and checks (§2.8).

The tree is region → nation → customer; suppliers hang under their nation,
and a few supplier rows are turned into the cases the checks must catch:
a 2-cycle, a self-reference and an orphan (parent not a node).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gildhall.operators import org_checks, org_paths
from gildhall.plans.registry import query


def org_nodes(t):
    r = t["region"].select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("node_id"),
                           F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("node_name"))
    n = t["nation"].select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("node_id"),
                           F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                           F.col("n_name").alias("node_name"))
    c = t["customer"].select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("node_id"),
                             F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent_id"),
                             F.col("c_name").alias("node_name"))
    k = F.col("s_suppkey")
    parent = (F.when(k % 20 == 0, F.concat(F.lit("S"), (k + 1).cast("string")))
               .when(k % 20 == 1, F.concat(F.lit("S"), (k - 1).cast("string")))
               .when(k % 20 == 2, F.concat(F.lit("S"), k.cast("string")))
               .when(k % 20 == 3, F.concat(F.lit("X"), k.cast("string")))
               .otherwise(F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))))
    s = t["supplier"].select(F.concat(F.lit("S"), k.cast("string")).alias("node_id"), parent.alias("parent_id"),
                             F.col("s_name").alias("node_name"))
    return r.unionByName(n).unionByName(c).unionByName(s)


NODES_SQL = """nodes AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS node_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS node_name FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR), c_name FROM customer
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR),
    CASE WHEN s_suppkey % 20 = 0 THEN 'S' || CAST(s_suppkey + 1 AS VARCHAR)
         WHEN s_suppkey % 20 = 1 THEN 'S' || CAST(s_suppkey - 1 AS VARCHAR)
         WHEN s_suppkey % 20 = 2 THEN 'S' || CAST(s_suppkey AS VARCHAR)
         WHEN s_suppkey % 20 = 3 THEN 'X' || CAST(s_suppkey AS VARCHAR)
         ELSE 'N' || CAST(s_nationkey AS VARCHAR) END, s_name FROM supplier)"""

PATHS_SQL = f"""RECURSIVE {NODES_SQL},
roots AS (SELECT * FROM nodes WHERE parent_id IS NULL OR parent_id NOT IN (SELECT node_id FROM nodes)),
p(node_id, parent_id, node_name, level, path, ids, root_id) AS (
  SELECT node_id, parent_id, node_name, 1, node_name, [node_id], node_id FROM roots
  UNION ALL
  SELECT n.node_id, n.parent_id, n.node_name, p.level + 1, p.path || ' / ' || n.node_name,
         list_append(p.ids, n.node_id), p.root_id
  FROM nodes n JOIN p ON n.parent_id = p.node_id
  WHERE n.parent_id <> n.node_id AND NOT list_contains(p.ids, n.node_id))"""


@query("q_org_path", f"""WITH {PATHS_SQL}
SELECT node_id, parent_id, node_name, CAST(level AS INTEGER) AS level, path, root_id FROM p""")
def q_org_path(t):
    """Root-to-node path, level and parent (REC-1, REC-2, JON-14)."""
    return org_paths(org_nodes(t))


@query("q_org_checks", f"""WITH {PATHS_SQL},
paths AS (SELECT node_id, level FROM p)
SELECT node_id, 'self_reference' AS issue, CAST(NULL AS INTEGER) AS level FROM nodes WHERE node_id = parent_id
UNION ALL
SELECT node_id, 'unreached', CAST(NULL AS INTEGER) FROM nodes WHERE node_id NOT IN (SELECT node_id FROM paths)
UNION ALL
SELECT node_id, 'deep', CAST(level AS INTEGER) FROM paths WHERE level > 2""")
def q_org_checks(t):
    """Self-references, nodes never reached from a root (cycles) and deep
    nodes (REC-3); the depth warning is set to 2 so the demo tree trips it."""
    nodes = org_nodes(t)
    return org_checks(nodes, org_paths(nodes), warn_depth=2)
