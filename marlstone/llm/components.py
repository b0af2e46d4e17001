"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node and comp, the same for all nodes that the edges (a, b) join; nodes without an edge are absent.

    In each round every node points to its smallest neighbour if that is smaller, pointers are followed a few steps,
    and the edges are drawn between the ends.  That at least halves the nodes of each component.  Rounds are written
    tables, so a lost executor costs one round at most.
    """
    left = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).withColumnRenamed("a", "node")
        for _ in range(2):
            up = written(up, "pointers")
            further = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
            up = up.join(further, "up").select("node", F.col("further").alias("up"))
        up = written(up, "pointers")
        labels = up.withColumnRenamed("up", "comp") if labels is None else _follow(labels, up)
        labels = written(labels, "labels")
        left = written(moved(left, up.withColumnRenamed("up", "comp")), "edges")
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def _follow(labels: DataFrame, up: DataFrame) -> DataFrame:
    return labels.join(up.withColumnRenamed("node", "comp"), "comp", "left").select(
        "node", F.coalesce("up", "comp").alias("comp")
    )


def moved(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between different components, each once; a node without a label is its own component."""
    for end in ("a", "b"):
        at = labels.select(F.col("node").alias(end), F.col("comp").alias("to"))
        edges = edges.join(at, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def merge_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after the links (a, b) are added to those that made ``labels``."""
    if labels is None:
        return components(links)
    more = components(moved(links, labels)).select(F.col("node").alias("comp"), F.col("comp").alias("up"))
    old = labels.join(more, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
    new = more.join(labels.select(F.col("node").alias("comp")), "comp", "left_anti")
    return written(old.unionByName(new.select(F.col("comp").alias("node"), F.col("up").alias("comp"))), "labels")
