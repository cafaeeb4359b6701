"""Connected components of a graph that may be as large as the corpus, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def roots(parents: DataFrame) -> DataFrame:
    """``parents`` (node, parent <= node) with every parent replaced by the root it leads to: pointer doubling."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parents = written(parents.join(up, "parent", "left").select("node", F.coalesce("grand", "parent").alias("to"), "parent"), "roots")
        moved = parents.where("`to` <> parent").limit(1).count()
        parents = parents.select("node", F.col("to").alias("parent"))
        if not moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node it is connected with) for all nodes of ``edges`` (a, b).

    Each round hooks every node to its smallest neighbour below it (a partial minimum before the shuffle, so a hub is no
    hot group), follows these parents to their roots, and contracts the edges to the roots' own. The number of
    nodes at least halves a round, as each one that is left with an edge hooks or is hooked to."""
    labels = None
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        found = roots(low.select("node", F.least("node", "low").alias("parent")))
        if labels is None:
            labels = found.withColumnRenamed("parent", "label")
        else:
            step = found.select(F.col("node").alias("label"), "parent")
            labels = written(labels.join(step, "label", "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        at_a = found.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        at_b = found.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        edges = written(edges.join(at_a, "a").join(at_b, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                        .where("a <> b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
