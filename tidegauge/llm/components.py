"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.scratch import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end hangs on one smaller end that hangs on none; then each star is a component."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    wrong = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)")
    return wrong.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); the component is its smallest id.

    Alternates two steps until all edges are stars: each node hands the smallest of its neighbours (and itself) to its larger
    neighbours, then to its smaller ones. A chain of n nodes takes about log n rounds. The smallest neighbour comes from
    a map-side minimum; the joins have a unique side, so a hub of millions of edges is only a skewed join.
    """
    edges = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.col("n")).alias("m"))
        large = both.filter("v > u").join(lowest, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(lowest, F.col("u") == F.col("n"))
        edges = stored(
            small.select("u", F.col("m").alias("v"))
            .union(small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        )
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
