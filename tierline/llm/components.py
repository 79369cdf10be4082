"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Each round gives a node the smallest name among its neighbours' and its own,
    then the name of that node (pointer jumping), until nothing changes. Rounds
    are written out, so lineage doesn't grow. A node with very many links is
    reduced before each shuffle and its rows are split by adaptive joins.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = stored(both.distinct(), "edges")
    names = stored(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "names")
    for _ in range(max_rounds):
        near = edges.join(names, edges.b == names.node).groupBy("a").agg(F.min("component").alias("_near"))
        lower = names.join(near, names.node == near.a).select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("component"))
        jump = names.select(F.col("node").alias("_of"), F.col("component").alias("_to"))
        after = lower.join(jump, F.col("component") == F.col("_of"), "left").select("node", "_old", F.least("component", F.coalesce("_to", "component")).alias("component"))
        after = stored(after, "names")
        names = after.select("node", "component")
        if after.where(F.col("component") < F.col("_old")).isEmpty():
            return names
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
