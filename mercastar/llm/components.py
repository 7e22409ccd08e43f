"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercastar.storage import durable


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Tie the neighbours of every node to its least neighbour (or itself).

    `links` are (u, v) with u > v. The small star takes neighbours below a node, the
    large star those above it. Minima are aggregated before they move, and the join
    back has one row for each node on its right side.
    """
    both = links if small else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if small:
        tied = tied.select(F.col("v").alias("x"), "m").unionByName(least.select(F.col("u").alias("x"), "m"))
    else:
        tied = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("x"), "m")
    return tied.where(F.col("x") != F.col("m")).select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `links (a, b)`; the root is the least node reachable.

    Alternating large and small stars: every round at least halves the depth of the
    trees, so rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder, which ends its lineage. The root itself has no row
    when it has no links.
    """
    now = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now = durable(now.distinct())
    mark = _mark(now)
    while mark[0]:
        now = durable(_stars(_stars(now, small=False), small=True))
        new = _mark(now)
        if new == mark:
            break
        mark = new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
