"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """Follow (node, root) pointers, always towards smaller nodes, to their ends by doubling."""
    while True:
        above = parents.select(F.col("node").alias("via"), F.col("root").alias("next"))
        jumped = stored(parents.join(above, parents["root"] == above["via"], "left").select(
            "node", F.coalesce("next", "root").alias("root"),
            (F.col("next") < F.col("root")).alias("moved")), "pointers")
        parents = jumped.select("node", "root")
        if not jumped.where("moved").take(1):
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers to their ends
    and contracts the links; every component of two or more nodes at least halves, so the rounds grow with
    the logarithm of the nodes. All rounds are joins and groupings over stored tables; joins on a node with many
    links have plain exchanges on both sides, so adaptive execution can split them. No links give no rows.
    """
    found: DataFrame | None = None
    while True:
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min("b").alias("least"))
        roots = _roots(stored(nearest.select(
            F.col("a").alias("node"), F.least("a", "least").alias("root")), "parents"))
        if found is None:
            found = roots
        else:
            later = roots.select(F.col("node").alias("via"), F.col("root").alias("end"))
            found = stored(found.join(later, found["root"] == later["via"], "left").select(
                "node", F.coalesce("end", "root").alias("root")), "roots")
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        half = stored(edges.join(left, "a").select("ra", "b"), "half-links")
        edges = stored(half.join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                       .where("a <> b").distinct(), "links")
        if not edges.take(1):
            return found
