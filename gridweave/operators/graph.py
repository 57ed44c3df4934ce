"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.sources.scratch import written


def with_least(edges: DataFrame, total: int, heavy: int) -> DataFrame:
    """Columns ``u``, ``v`` and ``m``, the smallest ``v`` of the row's ``u``.

    A node with more than ``heavy`` edges, or more than one in 10,000 of ``total``, would be one hot key of the join. Of such nodes there
    are at most 10,000, so theirs are broadcast, and their edges stay where they are; all others are joined by key.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    limit = max(heavy, total // 10_000)
    few = F.broadcast(least.where(F.col("n") > limit).select("u", "m"))
    rest = edges.join(few, "u", "left_anti").join(least.where(F.col("n") <= limit).select("u", "m"), "u")
    return edges.join(few, "u").unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, heavy: int = 100) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable) for each node of an edge with two different ends.

    Each round hangs neighbours onto the smallest one they know, first the larger ones and then the smaller
    (Kiveris et al., 2014); the number of rounds grows with the logarithm of the number of nodes. The edges of every round are a
    table in the shared folder; only their count and a checksum come to the driver. Nodes with over ``heavy`` edges are no hot keys
    (``with_least``). Edges with a null end and loops count for
    nothing, repeated edges count once, no edges give no rows.
    """
    star = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = _state(star)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, 2 * before[0], heavy).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # the smallest keeps its node, the others hang onto the smallest
        small = with_least(large, before[0], heavy).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        star = written(small.distinct(), "edges")
        after = _state(star)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(star: DataFrame) -> tuple:
    """Count and checksums of an edge table."""
    return tuple(star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1_000_003)))).first())
