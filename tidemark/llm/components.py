"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _star(near: DataFrame, name: str) -> DataFrame:
    """Rows (node, other): each other is linked to the least of its node's neighbourhood.

    The least ones are written before the join, so that a node with very many neighbours is a
    skewed side of a plain join, which adaptive execution splits.
    """
    least = materialize(near.groupBy("node").agg(F.min("other").alias("least")), f"{name}-least")
    joined = near.join(least.withColumn("least", F.least("least", "node")), "node")
    return joined


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node it can reach.

    Alternates two steps until nothing changes: every node links its larger neighbours, then its
    smaller ones, to the least of its neighbourhood. Each step keeps the components and the number
    of links at most as it was; rounds grow with the logarithm of the longest path. Each step's
    links are written to the shared folder, so lineage stays short and a lost executor costs one step.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links = materialize(links, "links")
    while True:
        both = links.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionAll(
            links.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        large = _star(both, "large").where("other > node").select(F.col("other").alias("hi"), F.col("least").alias("lo"))
        large = materialize(large.distinct(), "large")
        down = large.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
        small = _star(down, "small")
        small = small.select(F.col("other").alias("hi"), F.col("least").alias("lo")).unionAll(
            small.select(F.col("node").alias("hi"), F.col("least").alias("lo"))
        )
        after = materialize(small.where("hi <> lo").distinct(), "links")
        changed = after.join(links, ["hi", "lo"], "left_anti").limit(1).count() or after.count() != links.count()
        links = after
        if not changed:
            break
    # every node now hangs on its root alone
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
