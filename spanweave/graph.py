"""Connected components of a graph given as a table of links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut, forget


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for each node of a link: root is the smallest node of its component.

    ``links`` has two columns of one orderable type; nulls, loops and repeated links are ignored.
    Each round every node points its larger neighbours at its smallest one, then its smaller
    neighbours (large star, then small star), until the links are stars; the rounds grow with the
    logarithm of the graph.  Groups are reduced by min() before each shuffle, joins on a node's
    smallest neighbour are split by adaptive execution where a node has very many links, and each
    round's links are written as a table that replaces the one before, so nothing is gathered on the driver but two counts.
    """
    a, b = links.columns
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, edges = edges, cut(small.where("u <> v").distinct())
        forget(before)
        # Links are stars when no centre is itself a leaf; their number and sum then stay.
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"links are not yet stars after {max_rounds} rounds")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
