"""Connected components by repeated contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b; any order, repeats and loops allowed).

    Each round hooks every node to the smallest node of its neighbourhood,
    shortens the pointers, and replaces the links by links between what is
    left, so the link table shrinks by a factor in every round.  Parents and
    links of a round are written to the shared folder.  The root is some node
    of the component, the same one for all its nodes.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = stored(links.filter("a <> b").select(low, high).distinct(), "links")
    result = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
        for _ in range(2):
            hook = stored(hook, "hooks")
            to = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hook = hook.join(to, "root").select("node", F.col("next").alias("root"))
        hook = stored(hook, "hooks")
        result = hook if result is None else stored(
            result.join(hook.toDF("root", "next"), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")), "roots")
        x = hook.toDF("a", "ra")
        y = hook.toDF("b", "rb")
        edges = stored(edges.join(x, "a").join(y, "b").filter("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if result is None:
        result = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return result
