"""Connected components of links between node ids, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to (node, label), label being the smallest node of the component.

    Each round hooks a node to its smallest neighbour and that neighbour's own,
    and contracts the links to the ends' new labels. Contracted links that
    coincide or close on themselves go, so with ids in no order, as digests are,
    every round has far fewer than the one before. Ids that rise along a chain take
    a round for every two links; give such nodes a hash for an id. Nodes without
    links are not listed.
    """
    edges = materialise(contracted(links, "a", "b"), "edges")
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        next_ = hook.select(F.col("node").alias("to"), F.col("to").alias("root"))
        roots = materialise(hook.join(next_, "to").select("node", "root"), "roots")
        if labels is None:
            labels = roots.withColumnRenamed("root", "label")
        else:
            moved = roots.withColumnRenamed("node", "label")
            labels = materialise(labels.join(moved, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")
        a, b = roots.select(F.col("node").alias("a"), F.col("root").alias("x")), roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        edges = materialise(contracted(edges.join(a, "a").join(b, "b"), "x", "y"), "edges")
        if edges.isEmpty():
            return labels


def contracted(links: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links, smaller end first, without loops."""
    return links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
