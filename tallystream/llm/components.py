"""Connected components of an edge table, by contraction.

Each round hooks every node to its smallest neighbour, shortens the trees this gives until
each node points at its root, and rewrites the edges between roots. Nodes at least halve, so
rounds grow with the logarithm of the longest chain. Every table is written to the shared
folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.shared_files import join


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(edges: DataFrame, scratch: str) -> DataFrame:
    """node and component (smallest node it reaches) of every node of the edges (a, b: long).
    scratch: a folder all executors share, not used before. NULL ends and loops are ignored."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                    join(scratch, "edges-0"))
    labels, turn = None, 0
    while labels is None or not edges.isEmpty():
        roots = hooked(edges, join(scratch, f"roots-{turn}"))
        if labels is None:
            labels = roots
        else:
            to = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
            labels = labels.join(to, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
            labels = written(labels, join(scratch, f"labels-{turn}"))
        a, b = (roots.select(F.col("node").alias(c), F.col("component").alias(f"root_{c}")) for c in ("a", "b"))
        turn += 1
        between = edges.join(a, "a").join(b, "b").where("root_a <> root_b")
        edges = written(between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(),
                        join(scratch, f"edges-{turn}"))
    return labels


def hooked(edges: DataFrame, scratch: str) -> DataFrame:
    """Every node with the root of its tree of smallest neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    tree = written(near.select("node", F.least("node", "least").alias("component")), join(scratch, "0"))
    for turn in range(1, 64):
        up = tree.select(F.col("node").alias("component"), F.col("component").alias("root"))
        tree = tree.join(up, "component").select("node", F.col("root").alias("component"),
                                                 (F.col("root") < F.col("component")).alias("moved"))
        tree = written(tree, join(scratch, str(turn)))
        if tree.where("moved").isEmpty():
            break
    return tree.select("node", "component")
