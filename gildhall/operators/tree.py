"""Organisation tree paths (REC-1..REC-3).

Pointer doubling instead of a recursive CTE (which has a default row limit)
or one join a level: every node points to an ancestor and, in each round,
takes over its ancestor's pointer, so the distance covered doubles. A tree of
depth d is done after log2(d) + 1 joins; there is no depth limit. Nodes that
point to a root drop out of the rounds. When a round brings no further node
to its root, the rest hang on a cycle: of every node still on its way to a
root an ancestor would have arrived.

Pointers go first, without names, so nodes of a cycle never gather a path;
paths are then put together in the same way for the nodes that have a root.
Each round is checkpointed (reliable, shared folder): its input is computed
once and lineage stays one round deep. The driver sees one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildhall.session import checkpoint_dir


def _doubled(state: DataFrame, join_path) -> tuple[DataFrame, DataFrame]:
    """(rows that have arrived at a root, rows that have not) of ``state``.

    ``state``: ``node_id``, ``_anc`` (NULL: the node is a root), ``level``
    (edges to ``_anc``; of a root 1, counting itself) and ``path``;
    ``join_path(ancestor's, own)`` puts two paths together.
    """
    arrived, going = state.filter(F.col("_anc").isNull()), state.filter(F.col("_anc").isNotNull())
    n = going.count()
    while n:
        known = arrived.unionByName(going).select(
            F.col("node_id").alias("_a_id"), F.col("_anc").alias("_a_anc"), F.col("level").alias("_a_level"),
            F.col("path").alias("_a_path"), F.col("root_id").alias("_a_root"))
        step = going.join(known, F.col("_anc") == F.col("_a_id")).select(
            "node_id", F.col("_a_anc").alias("_anc"), (F.col("level") + F.col("_a_level")).alias("level"),
            join_path(F.col("_a_path"), F.col("path")).alias("path"), F.col("_a_root").alias("root_id"))
        step = step.checkpoint(eager=True)
        arrived = arrived.unionByName(step.filter(F.col("_anc").isNull()))
        going = step.filter(F.col("_anc").isNotNull())
        left = going.count()
        if left == n:
            break
        n = left
    return arrived, going


def org_paths(nodes: DataFrame, node: str = "node_id", parent: str = "parent_id", name: str = "node_name",
              sep: str = " / ") -> DataFrame:
    """Root-to-node paths: ``(node_id, parent_id, node_name, level, path, root_id)``.

    Roots: parent NULL, or parent not a node (orphans start their own tree).
    Nodes on a cycle (a self-reference too) or under one have no path and are
    left out; ``org_checks`` names them. ``node`` must be unique. Rows with a
    NULL node are roots that nothing hangs under.
    """
    checkpoint_dir(nodes.sparkSession)
    n = nodes.select(F.col(node).alias("node_id"), F.col(parent).alias("parent_id"),
                     F.col(name).cast("string").alias("node_name")).checkpoint(eager=True)
    ids = n.select(F.col("node_id").alias("_pid")).distinct()
    # the parent as a pointer, where it is a node
    state = n.join(ids, n["parent_id"] == ids["_pid"], "left").select(
        "node_id", "parent_id", "node_name", F.col("_pid").alias("_anc"), F.lit(1).alias("level"),
        F.when(F.col("_pid").isNull(), F.col("node_id")).alias("root_id")).checkpoint(eager=True)
    lean = state.select("node_id", "_anc", "level", F.lit(None).cast("string").alias("path"), "root_id")
    _, lost = _doubled(lean, lambda above, own: F.lit(None).cast("string"))
    rooted = state.join(lost.select("node_id"), "node_id", "left_anti")
    full, _ = _doubled(rooted.select("node_id", "_anc", "level", F.col("node_name").alias("path"), "root_id").checkpoint(eager=True),
                       lambda above, own: F.concat(above, F.lit(sep), own))
    kept = n.select(F.col("node_id").alias("_n_id"), "parent_id", "node_name")
    return full.join(kept, F.col("node_id").eqNullSafe(F.col("_n_id"))).select(
        "node_id", "parent_id", "node_name", "level", "path", "root_id")


def org_checks(nodes: DataFrame, paths: DataFrame, node: str = "node_id", parent: str = "parent_id",
               warn_depth: int = 6) -> DataFrame:
    """Per-node problems: ``self_reference``, ``unreached`` (on a cycle or under
    one, so without a root), ``deep`` (level above ``warn_depth``)."""
    n = nodes.select(F.col(node).alias("node_id"), F.col(parent).alias("parent_id"))
    selfref = n.filter(F.col("node_id") == F.col("parent_id")).select(
        "node_id", F.lit("self_reference").alias("issue"), F.lit(None).cast("int").alias("level"))
    reached = paths.select("node_id").distinct()
    unreached = n.join(reached, "node_id", "left_anti").select(
        "node_id", F.lit("unreached").alias("issue"), F.lit(None).cast("int").alias("level"))
    deep = paths.filter(F.col("level") > warn_depth).select(
        "node_id", F.lit("deep").alias("issue"), F.col("level").cast("int"))
    return selfref.unionByName(unreached).unionByName(deep)
