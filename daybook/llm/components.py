"""Connected components of a table of links, in rounds over shrinking tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import Work

_MAX_ROUNDS = 60


def _order(node: Column) -> Column:
    """A shuffled order, so that a chain of neighbouring ids shrinks as fast as any other graph."""
    return F.struct(F.xxhash64(node).alias("h"), node.alias("node"))


def connected(links: DataFrame, work: Work, name: str) -> DataFrame:
    """``links`` has long columns ``a`` and ``b``; returns ``node``, ``component_id``.

    Every node named by a link gets the smallest node that it can reach. Links
    may repeat or point at themselves; no links give no rows. Each round, every
    node follows its first neighbour in a shuffled order if that comes before
    itself, links move to the nodes followed, and links within one node go.
    Expected rounds grow with the logarithm of the nodes. A node with very many
    links is combined before the shuffle, and lookups join tables that adaptive
    execution can split.
    """
    spark = work.spark
    edges = work.keep(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges-0"
    )
    followed: list[DataFrame] = []
    while not edges.isEmpty():
        if len(followed) == _MAX_ROUNDS:
            raise RuntimeError("components do not settle")
        k = len(followed)
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        first = ends.groupBy("node").agg(F.min(_order(F.col("other"))).alias("least"))
        parent = work.keep(
            first.select(
                "node",
                F.when(F.col("least") < _order(F.col("node")), F.col("least.node"))
                .otherwise(F.col("node"))
                .alias("parent"),
            ),
            f"{name}-parent-{k}",
        )
        followed.append(parent)
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = work.keep(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            f"{name}-edges-{k + 1}",
        )
    if not followed:
        return spark.createDataFrame([], "node long, component_id long")
    roots = followed[-1].select("node", F.col("parent").alias("root"))
    for parent in reversed(followed[:-1]):
        above = roots.select(F.col("node").alias("parent"), "root")
        roots = work.keep(
            parent.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")),
            f"{name}-roots-{parent.schema.fieldNames()[0]}-{followed.index(parent)}",
        )
    least = work.keep(roots.groupBy("root").agg(F.min("node").alias("component_id")), f"{name}-least")
    return roots.join(least, "root").select("node", "component_id")
