"""Connected components of an edge table, by alternating large and small stars.

Every round hangs neighbours on the least node they see; minima are partial
aggregates and the joins can be split by adaptive execution, so one node may
hold any share of the edges. Each round is written to the shared folder. Node
ids never reach the driver; it compares one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import saved


def _star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("lo")).select(F.col("a").alias("at"), F.least("a", "lo").alias("lo"))
    met = both.join(least, F.col("a") == F.col("at"))
    if small:
        out = met.select(F.explode(F.array("a", "b")).alias("a"), F.col("lo").alias("b"))
    else:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("lo").alias("b"))
    return out.filter("a > b").distinct()


def components(edges: DataFrame, folder: str, rounds: int = 50) -> DataFrame:
    """(node, component) of every node with an edge; edges (a, b) are longs, component the least node."""
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), f"{folder}/0")
    seen = None
    for k in range(1, rounds):
        edges = saved(_star(_star(edges, False), True), f"{folder}/{k}")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
