"""Distributed union-find: connected components of an edge table by repeated contraction.

Every round gives each node a fresh random priority, points each node to the neighbour (or itself) of least priority and replaces both
ends of every edge by what they point to. Random priorities shrink chains and stars alike by a constant factor, so the rounds grow with the
logarithm of the largest component. Each round is a written table; nothing but the number of edges left reaches the driver.
A hub with many links is combined in each task before its shuffle; the join on it can be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import cut_lineage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``id, root``: every node with at least one edge to another, and the least id of its component.

    ``edges`` has bigint columns ``a, b``; loops, repeated and reversed edges and nulls do no harm.
    """
    left = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).filter("a <> b")
    left = cut_lineage(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    nodes = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select("b", "a"))
        # hash of id and round, then the id itself: the least struct is the neighbour of least priority
        draw = F.struct(F.xxhash64(F.col("b"), F.lit(len(steps))).alias("draw"), F.col("b").alias("id"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(len(steps))).alias("draw"), F.col("a").alias("id"))
        step = both.groupBy("a").agg(F.least(F.min(draw), F.first(own)).getField("id").alias("to"))
        step = cut_lineage(step, f"{name}-step")
        steps.append(step)
        moved = left.join(step.select("a", F.col("to").alias("u")), "a").select("u", "b")
        moved = moved.join(step.select(F.col("a").alias("b"), F.col("to").alias("v")), "b").filter("u <> v")
        left = cut_lineage(moved.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), f"{name}-edges")
    if not steps:
        return nodes.select("id", F.col("id").alias("root"))
    # follow the pointers from the last round back to the first
    label = steps[-1].select(F.col("a").alias("id"), F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        onward = step.alias("s").join(label.alias("l"), F.col("s.to") == F.col("l.id"), "left")
        label = onward.select(F.col("s.a").alias("id"), F.coalesce("l.root", "s.to").alias("root"))
    label = cut_lineage(label, f"{name}-labels")
    least = label.groupBy("root").agg(F.min("id").alias("least"))
    return label.join(least, "root").select("id", F.least("least", "root").alias("root"))
