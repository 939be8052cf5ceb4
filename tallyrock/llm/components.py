"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrock.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); a component is named by its smallest node.

    Each round hangs a node's larger neighbours, and then its smaller ones, on the smallest node
    it knows, until all hang on roots: a logarithmic number of rounds. Rows are grouped by partial
    aggregation and joined, so a node with very many links is no single task; every round is a
    written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    while not are_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v")  # one row an edge at most
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(lowest, "u")
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionAll(joined.select("u", F.col("low").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def are_stars(edges: DataFrame) -> bool:
    """Whether every node (u) hangs on one other (v), which hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0
