"""Connected components by repeated contraction, in Spark joins.

Each round every node points to its smallest neighbour (or itself), pointers
are followed twice, and the graph is contracted to the roots. A component
loses at least half of its nodes per round; a star of any size is done in one.
Every round is written to shared storage, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import scratch


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b) longs. Returns (node, root) for every node with an edge;
    root is the same for connected nodes and is one of them."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    edges = scratch(both.where("a <> b").distinct(), "cc-edges")
    roots = None
    while edges.take(1):
        up = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
        parent = scratch(up.select(F.col("a").alias("node"), "p"), "cc-parent")
        for _ in range(2):
            above = parent.select(F.col("node").alias("n2"), F.col("p").alias("p2"))
            parent = parent.join(above, F.col("p") == F.col("n2")).select("node", F.col("p2").alias("p"))
        parent = scratch(parent, "cc-parent")
        if roots is None:
            roots = parent.select("node", F.col("p").alias("root"))
        else:
            step = parent.select(F.col("node").alias("n2"), "p")
            roots = scratch(
                roots.join(step, F.col("root") == F.col("n2"), "left").select("node", F.coalesce("p", "root").alias("root")),
                "cc-roots",
            )
        pa = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        edges = scratch(
            edges.join(pa, "a").join(pb, "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(),
            "cc-edges",
        )
    if roots is None:
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
