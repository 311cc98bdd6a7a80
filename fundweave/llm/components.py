"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and one join; labels and edges stay in tables. Each step is written
to the shared folder, so lineage stays short and a lost executor costs a re-read; steps that nobody
reads any more are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundweave.sources.workspace import cut, discard


def _stars(pairs: DataFrame) -> DataFrame:
    """Hangs every v of (u, v) on the least node next to u (u itself included). A hub has as many pairs
    as its component has nodes: keys in a struct make Spark shuffle both sides of the join, which lets
    it split the hub's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.struct("u").alias("c"), F.least("u", "m").alias("m")
    )
    return pairs.join(least, F.struct("u") == F.col("c")).select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    hung = _stars(edges)
    moved = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = edges.groupBy("u").agg(F.min("v").alias("v"))
    return moved.union(kept).filter("u != v").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), the root being the least node of its
    component. An empty table gives an empty result; loops and repeated edges do no harm."""
    spark, mark, last = edges.sparkSession, None, []
    now = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct(),
        "edges",
        last,
    )
    while True:
        state = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state.n == 0 or (state.n, state.h) == mark:
            break
        mark, done, last = (state.n, state.h), last, []
        large = cut(_large(now).distinct(), "large", done)
        now = cut(_small(large), "small", last)
        discard(spark, done)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
