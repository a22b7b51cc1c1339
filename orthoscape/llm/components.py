"""Connected components of an edge table, on the cluster only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Stage


def connected_components(edges: DataFrame, stage: Stage, name: str, max_rounds: int = 60) -> DataFrame:
    """Columns (node, root) for each node of edges (a, b); root is the component's smallest node.

    Alternates two star operations: each node hands its larger neighbours to
    its smallest neighbour, then its smaller ones.  The number of rounds grows
    with the logarithm of the longest chain.  Both steps need the minimum of a
    node's neighbours only, which is combined before the shuffle; a hub's join
    side is split by adaptive execution.  Null and self edges count for
    nothing.  Each round is a staged table, so losing an executor repeats one
    round at most.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, last = stage.write(pairs, f"{name}-0"), f"{name}-0"

    def stars(p: DataFrame, both: bool) -> DataFrame:
        """Large star when both directions count, else small star; (u > v) rows in and out."""
        near = p.unionByName(p.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else p
        low = near.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        joined = near.join(low, "u")
        if both:
            return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        kept = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return kept.unionByName(low.select("u", F.col("m").alias("v"))).distinct()

    def mark(p: DataFrame) -> tuple:
        return tuple(p.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(pairs)
    for i in range(1, max_rounds + 1):
        larger = stars(pairs, True)
        pairs = stage.write(stars(larger, False), f"{name}-{i}")
        now = mark(pairs)
        stage.drop(last)
        last = f"{name}-{i}"
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
