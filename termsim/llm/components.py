"""Connected components of an edge table, by alternating large-star and
small-star steps (each a map-side combined ``min`` and one join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = _both_ways(edges)
    low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(low.select("u", F.col("m").alias("v")))
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id of ``edges(u, v)``, ``component`` being the
    smallest id reachable. Self-loops are ignored (their ids have no row).

    The tables go through the shared folder between rounds; the driver sees one
    row of sums per round. Rounds grow with the logarithm of the longest chain;
    past ``max_rounds`` the call fails instead of giving a wrong answer.
    """
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        now = written(_small_star(_large_star(now)).where("u != v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if state == before:
            # every id now points at its root
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
