"""Connected components of an edge table, by repeated contraction in Spark.

Each round every node takes the smallest label among itself and its neighbours, then the
label of that label. Sums of a round show whether anything changed. Every round is written
to the shared folder, so a lost executor costs one round at most. Nodes with many edges are
reduced by partial minima before rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import store


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for all nodes of edges (a, b)."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = store(both.filter("a <> b").distinct(), "edges")
    labels = store(
        both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")),
        "components",
    )
    while True:
        # Smallest label among the neighbours of a node and its own.
        seen = both.join(labels, both["b"] == labels["node"]).select("a", "component")
        lowest = seen.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        # The label of a node hears of it too, so that whole trees follow their root.
        near = labels.join(lowest, "node").withColumn("near", F.least("near", "component"))
        roots = near.groupBy(F.col("component").alias("root")).agg(F.min("near").alias("low"))
        moved = near.join(roots, near["component"] == roots["root"]).select(
            "node", "component", F.least("near", "low").alias("next")
        )
        moved = store(moved, "components-step")
        jumps = moved.select(F.col("node").alias("at"), F.col("next").alias("further"))
        following = moved.join(jumps, moved["next"] == jumps["at"]).select(
            "node",
            F.least("next", "further").alias("component"),
            (F.least("next", "further") != F.col("component")).alias("changed"),
        )
        following = store(following, "components")
        labels = following.select("node", "component")
        if not following.filter("changed").limit(1).collect():
            return labels
