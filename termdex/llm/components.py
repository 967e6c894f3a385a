"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termdex.llm.common import saved


def _roots(hooks: DataFrame) -> DataFrame:
    """Pointer jumping: ``(node, up)`` with every ``up`` replaced by the end of its chain."""
    while True:
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
        jumped = saved(hooks.join(above, "up", "left").select("node", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), "hooks")
        hooks = jumped.select("node", "up")
        if jumped.filter("moved").isEmpty():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges -> ``(node, label)``, label = smallest node of its component.

    Every node hooks onto its smallest neighbour, if that is smaller; chains of hooks are
    shortened to their roots, the edges are contracted to roots, and what is left goes into
    the next round. Each round ends in tables in the shared folder. Nulls take no part. A
    hub is only ever aggregated, or joined as one row per edge.
    """
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    rest = saved(edges.filter("a is not null and b is not null and a <> b").select(*ordered("a", "b")).distinct(), "edges")
    rounds = []
    while not rest.isEmpty():
        hooks = _roots(saved(rest.groupBy("b").agg(F.min("a").alias("up")).withColumnRenamed("b", "node"), "hooks"))
        rounds.append(hooks)
        ends = rest.join(hooks.toDF("b", "ub"), "b").join(hooks.toDF("a", "ua"), "a", "left")
        rest = saved(ends.select(*ordered(F.coalesce("ua", "a"), F.col("ub"))).filter("a <> b").distinct(), "edges")
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("label"))
    # a round's nodes are roots of the rounds before it
    labels = rounds.pop()
    for hooks in reversed(rounds):
        later = labels.toDF("up", "top")
        labels = hooks.join(later, "up", "left").select("node", F.coalesce("top", "up").alias("up")).union(labels)
    labels = saved(labels.toDF("node", "label"), "labels")
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
