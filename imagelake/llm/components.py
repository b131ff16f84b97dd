"""Connected components of an edge table by contraction (no collected edges)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import materialize


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component: smallest node reachable) of every node in ``edges``, a table (a, b).

    Every round each node hooks onto the first of itself and its neighbours, in the
    order of ids in round one and in a random order in each later round; edges are
    renamed to the nodes hooked onto, and edges within a node go. A constant share of
    the nodes goes each round, whatever the graph's shape. A hub's edges are never
    gathered: the hook is a partial aggregate, and both sides of each join are shuffled
    tables that can be split. The rounds' hooks are followed one after the other in the end.
    """
    left = edges.select("a", "b").where("a <> b")
    names = None
    turn = 0
    while turn == 0 or not left.isEmpty():
        turn += 1
        # first by id, which settles stars around their smallest node at once
        place = lambda c: F.xxhash64(F.lit(turn), c) if turn > 1 else F.lit(0).cast("long")  # noqa: E731, B023
        first = lambda c: F.struct(place(c).alias("o"), F.col(c).alias("to"))  # noqa: E731, B023
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(spark, both.groupBy("a").agg(F.min(first("b")).alias("b")).select(
            F.col("a").alias("was"), F.least(first("a"), F.col("b"))["to"].alias("now")), "hooks")
        if names is None:  # the first hooks name every node
            names = hooks.select(F.col("was").alias("node"), F.col("now").alias("root"))
        else:
            names = names.join(hooks, names["root"] == hooks["was"], "left").select(
                "node", F.coalesce("now", "root").alias("root"))
        near = left.join(hooks.select(F.col("was").alias("a"), F.col("now").alias("a2")), "a").join(
            hooks.select(F.col("was").alias("b"), F.col("now").alias("b2")), "b").where("a2 <> b2")
        left = materialize(spark, near.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
    names = materialize(spark, names, "names") if turn > 1 else names
    least = names.groupBy("root").agg(F.min("node").alias("component"))
    return names.join(least, "root").select("node", "component")
