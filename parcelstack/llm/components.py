"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _lowest(pairs: DataFrame) -> DataFrame:
    """Adds m, the smallest v of each u. The redundant key gives the join an
    exchange of its own, whose large partitions (hubs) can be split."""
    spread = F.xxhash64("u").alias("spread")
    m = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.select("*", spread).join(m.select("*", spread), ["u", "spread"]).drop("spread")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the smallest of u and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    near = _lowest(edges)  # u > v in every row
    return near.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        near.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links` (a, b): root is the smallest node
    it is connected with. Rounds are few (logarithmic in the longest chain);
    each ends in a checkpoint, and the driver sees only two numbers of it."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        n = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n == mark:
            break
        mark = n
        edges = cut(_small_star(_large_star(edges)))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
