"""Connected components of a graph given by its edges, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for all nodes of the edges (columns a, b).

    Alternates large-star and small-star steps (Kiveris et al., 2014), which
    need a number of rounds that grows with the logarithm of the longest path.
    Every step is one aggregation and one join; a hub's neighbours are never
    gathered in one row.  Each round is written to the shared folder."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large-star: larger neighbours of a node go to the least node of its neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small-star: smaller neighbours of a node, and the node itself, go to the least of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        new = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        same = new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty()
        edges = new
        if same:
            break
    stars = edges.groupBy("a").agg(F.min("b").alias("label"))
    return stars.select(F.col("a").alias("node"), "label").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
