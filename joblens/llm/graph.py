"""Connected components of an edge table by contraction, for any component size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): component is the
    smallest id reachable.

    Each round hooks every vertex to its smallest smaller neighbour, follows
    the hooks a few steps, moves the edges to the vertices reached and drops
    those that became loops.  Rounds grow with the logarithm of a component's
    size; minima are summed before the shuffle, so a hub is no hot key.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = saved(links, "links")
    labels = None
    while not links.isEmpty():
        # A vertex with a smaller neighbour appears as b: its parent is its smallest a.
        parent = saved(links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("parent")), "parents")
        for _ in range(2):
            above = parent.select(F.col("id").alias("parent"), F.col("parent").alias("next"))
            parent = parent.join(above, "parent", "left").select("id", F.coalesce("next", "parent").alias("parent"))
        parent = saved(parent, "parents")
        if labels is None:
            ids = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
            labels = ids.join(parent, "id", "left").select("id", F.coalesce("parent", "id").alias("component"))
        else:
            up = parent.select(F.col("id").alias("component"), "parent")
            labels = labels.join(up, "component", "left").select("id", F.coalesce("parent", "component").alias("component"))
        labels = saved(labels, "labels")
        moved = links
        for end in ("a", "b"):
            moved = moved.join(parent.select(F.col("id").alias(end), "parent"), end, "left").withColumn(end, F.coalesce("parent", end)).drop("parent")
        links = saved(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
