"""Graphs as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.session import cut, release


def star_edges(members: DataFrame, key: str, node: str) -> DataFrame:
    """``src, dst``: each key's members linked to its smallest; the same components as all pairs, with one edge a member."""
    hub = members.groupBy(key).agg(F.min(node).alias("src"))
    return members.join(hub, key).where(F.col(node) != F.col("src")).select("src", F.col(node).alias("dst")).distinct()


def components(edges: DataFrame, nodes: DataFrame | None = None, most_rounds: int = 50) -> DataFrame:
    """``node, component`` (its smallest node) by alternating large-star and small-star steps.

    Null ends, loops and repeats make no link; ``nodes`` (one column ``node``) adds lone nodes.
    """
    e = edges.where("src is not null and dst is not null").select("src", "dst")
    ends = e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()
    all_nodes = ends if nodes is None else ends.union(nodes.select("node")).where("node is not null").distinct()
    e = cut(e.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())

    def sign(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = sign(e)
    for _ in range(most_rounds):
        before = e
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        e = cut(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = sign(e)
        release(before)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return all_nodes.join(e.select(F.col("u").alias("node"), "v"), "node", "left").groupBy("node").agg(F.min("v").alias("v")).select("node", F.coalesce("v", "node").alias("component"))


def fully_connected(groups: DataFrame, connected: DataFrame) -> DataFrame:
    """``component``: groups (``node, component``) all of whose nodes are among ``connected`` (``node``)."""
    known = connected.select("node").distinct().withColumn("_c", F.lit(True))
    return groups.join(known, "node", "left").groupBy("component").agg(F.bool_and(F.coalesce("_c", F.lit(False))).alias("all")).where("all").select("component")
