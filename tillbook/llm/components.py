"""Connected components of a link table by alternating large and small stars.

Every round is two aggregations and two joins, written to the shared folder, so a lost executor repeats
tasks of one round only. Neighbours of a node are never collected; a node with many links is a skewed
join key, which Spark splits. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.session import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links(u, v) that is linked to another; root is the least node reachable.

    Rows with a null end, links of a node to itself and repeated links change nothing; no link, no row.
    """
    edges = pin(links.select("u", "v").filter("u <> v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = pin(_small_star(_large_star(edges)), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
