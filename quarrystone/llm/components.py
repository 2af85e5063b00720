"""Connected components of a graph given as a table of links.

Every round each node takes the least of itself and its neighbours in a random order of the nodes (a
minimum with partial aggregation, so a hub is no hot key), links are carried over to what their ends took,
and loops and repeats go.  The number of nodes with links falls by a constant share in each round,
whatever the shape of the graph; each round's tables are written, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written


def _order(node) -> F.Column:
    return F.struct(F.xxhash64(node, F.lit("order")), node.alias("node"))


def components(links: DataFrame) -> DataFrame:
    """``links`` has bigint columns a and b; returns node and component, its smallest node."""
    edges = written(links.where("a <> b").select("a", "b").distinct())
    labels = written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct())
    labels = labels.withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(_order(F.col("a")), F.min(_order(F.col("b")))).alias("m"))
        least = written(least.select(F.col("a").alias("old"), F.col("m.node").alias("new")))
        labels = written(
            labels.join(least, F.col("label") == F.col("old"), "left").select(
                "node", F.coalesce("new", "label").alias("label")
            )
        )
        to = [least.select(F.col("old").alias(k), F.col("new").alias(f"{k}_new")) for k in ("a", "b")]
        moved = edges.join(to[0], "a").join(to[1], "b")
        edges = written(
            moved.where("a_new <> b_new").select(F.col("a_new").alias("a"), F.col("b_new").alias("b")).distinct()
        )
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
