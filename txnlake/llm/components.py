"""Connected components of a graph of links, with alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlake.llm.common import stage

# At most this many nodes count as hot, so their table may be broadcast whatever the graph.
HOT_NODES = 256


def _with_lowest(rows: DataFrame, node: str, other: str) -> DataFrame:
    """Rows with the smallest neighbour of their node as low.

    Nodes that hold more than 1/256 of the rows are joined by broadcast (there are fewer than
    256 of them), all others by a shuffle in which no key is hot.
    """
    lows = stage(rows.groupBy(node).agg(F.min(other).alias("low"), F.count("*").alias("_n")), "lows")
    total = lows.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    is_hot = F.col("_n") * HOT_NODES > total
    few = F.broadcast(lows.filter(is_hot).select(node, F.col("low").alias("_hot")))
    marked = rows.join(few, node, "left")
    rest = marked.filter("_hot IS NULL").drop("_hot").join(lows.filter(~is_hot).drop("_n"), node)
    return marked.filter("_hot IS NOT NULL").withColumnRenamed("_hot", "low").unionByName(rest)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Smallest node reachable from each linked node, as columns node and root.

    Nodes are longs. Each round hangs all larger neighbours of a node below its smallest one
    (large star), then all smaller neighbours (small star); it ends when a round changes
    nothing, which takes about the logarithm of the longest path. Rounds are written tables, so
    a lost executor repeats one round at most. Loops and repeated links do no harm; no links give
    an empty result.
    """
    pairs = stage(links.filter(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("root")).distinct(), "links")
    state = None
    while True:
        found = pairs.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            return pairs
        state = found
        both = pairs.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            pairs.select(F.col("root").alias("u"), F.col("node").alias("v")))
        large = _with_lowest(both, "u", "v").filter("v > u").select(
            F.col("v").alias("node"), F.least("low", "u").alias("root")).distinct()
        large = stage(large, "large")
        near = _with_lowest(large, "node", "root")
        pairs = stage(near.select("node", F.col("low").alias("root")).unionByName(
            near.filter("root != low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        ).distinct(), "links")
