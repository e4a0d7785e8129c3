"""Connected components of a link table, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.plans.sizing import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (a, b); a component is named by
    one of its nodes.

    Each round points every node at its smallest neighbour, follows the pointers
    twice and contracts the links. A node that is nobody's larger neighbour stays, so
    at least half of the nodes vanish in a round and the number of rounds is
    logarithmic. Every table of a round is written to the shared folder. Empty links
    give an empty table; a link of a node with itself gives the node alone.
    """
    edges = written(
        links.select("a", "b")
        .union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct(),
        "edges",
    )
    parts = []
    while not edges.isEmpty():
        pointer = written(
            edges.groupBy("a")
            .agg(F.min("b").alias("b"))
            .select("a", F.least("a", "b").alias("p")),
            "pointer",
        )
        jump = _follow(_follow(pointer, pointer), pointer)
        jump = written(jump, "jump")
        parts.append(jump)
        left = jump.select(F.col("a"), F.col("p").alias("pa"))
        right = jump.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        edges = written(
            edges.join(left, "a")
            .select("pa", "b")
            .join(right, "b")
            .where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .distinct(),
            "edges",
        )
    if not parts:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = parts[0]
    for part in parts[1:]:
        found = _follow(found, part)
    return written(found, "components").toDF("node", "component")


def _follow(pointer: DataFrame, by: DataFrame) -> DataFrame:
    """Replace each target by the target's own target, if it has one."""
    step = by.select(F.col("a").alias("p"), F.col("p").alias("q"))
    return pointer.join(step, "p", "left").select("a", F.coalesce("q", "p").alias("p"))
