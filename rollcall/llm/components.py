"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import pin


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest among the node and its neighbours.

    The large star moves the neighbours above the node, the small star the node and its
    neighbours below. Minima are combined before the shuffle; a node with very many
    neighbours is split by the join with the minima, whose other side has one row a node.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    moved = joined.where("v > u" if large else "v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is the least node it reaches.

    Links may come in either direction, repeated, or from a node to itself. Each
    contraction is written to the shared folder and read back, so a lost executor costs
    one step at most. The number of rounds grows with the logarithm of the longest chain;
    only one sum per round reaches the driver.
    """
    links = pin(links.select("a", "b").where("a <> b").distinct(), label)
    state = None
    while True:
        links = pin(_starred(pin(_starred(links, large=True), label), large=False), label)
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))
        ).first()
        if now == state:
            break
        state = now
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
