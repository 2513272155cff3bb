"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventspark.session import reliable_checkpoint


def connected_components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, component)`` of the undirected graph ``links(u, v)``: the smallest node reachable, for nodes with links.

    Alternating star contraction: every round sends each node's larger neighbours to its smallest one, then each
    node's smaller neighbours to the smallest of them, until every component is a star around its smallest node.  All
    steps are joins, minima (combined map-side) and distincts; the number of links never grows.  The minima are
    written before they are joined, so both join sides are plain shuffles whose large partitions Spark may split.
    Null ends and self links are ignored.
    """
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    e = reliable_checkpoint(links.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(u, v).distinct())
    for _ in range(max_rounds):
        if _is_stars(e):
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = reliable_checkpoint(both.groupBy("u").agg(F.min("v").alias("m"))
                                  .select("u", F.least("u", "m").alias("m")))
        e = reliable_checkpoint(both.filter("v > u").join(low, "u")
                                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = reliable_checkpoint(e.groupBy("u").agg(F.min("v").alias("m")))
        e = reliable_checkpoint(e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                                .union(low.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def _is_stars(e: DataFrame) -> bool:
    """Whether each larger end has one link and no node is both a larger and a smaller end."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.filter("up > 1 OR (up > 0 AND down > 0)").limit(1).count() == 0
