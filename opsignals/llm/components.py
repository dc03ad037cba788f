"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsignals.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node and root of every end of a link (a, b); root is the smallest node reached.

    Each pass gives a node the least root among its neighbours' and its root's, so paths halve. Rows
    per node are combined before they are shuffled, and each pass starts from a written table.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        near = both.join(state, both.b == state.node).groupBy("a").agg(F.min("root").alias("near"))
        roots = state.select(F.col("node").alias("root"), F.col("root").alias("far"))
        fresh = (
            state.join(near, state.node == near.a)
            .join(roots, "root", "left")
            .select("node", F.least("near", "far", "root").alias("root"), (F.least("near", "far", "root") < F.col("root")).alias("moved"))
        )
        fresh = written(fresh, "roots")
        state = fresh.select("node", "root")
        if fresh.filter("moved").isEmpty():
            return state


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components of earlier ``links`` (node, root) with more links: only those between two
    components count, one for each pair of them, so a link is walked once."""
    a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"of_{c}")) for c in ("a", "b"))
    placed = links.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    ends = placed.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a <> b").distinct()
    more = components(ends)
    known = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("now")), "root", "left")
    known = known.select("node", F.coalesce("now", "root").alias("root"))
    fresh = more.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return written(known.unionByName(fresh), "roots")
