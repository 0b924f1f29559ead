"""Connected components of a link table by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from .common import materialise


def _both_ways(edges):
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges):
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (
        near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    )


def _small_star(edges):
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _mark(edges):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges):
    """Node and smallest node reachable, for every node of `edges` (a long, b long; any direction).

    Each step is two shuffles of at most one row per link, grouped minima pre-aggregate, and the links are
    written between steps (spark.checkpoint.dir), so a lost executor costs one step. Nodes without links do not
    occur; null ends and self-links are ignored; no links give an empty table.
    """
    edges = materialise(edges.select("a", "b").filter("a <> b").distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = materialise(_small_star(_large_star(edges)))
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
