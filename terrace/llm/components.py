"""Connected components of an edge table by alternating stars, all in joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (or the smaller) neighbours of each node to its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = near.join(least, "u")
    pairs = tied.where("v > u").select("v", "m") if large else tied.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    return pairs.where("v <> m").select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node."""
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
