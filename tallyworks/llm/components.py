"""Connected components of a table of edges, by alternating large-star and small-star steps.

Each step sends every vertex's smallest neighbour to the others: minima are pre-aggregated before the
shuffle, and joins have one unique side, so vertices with many edges are no burden. Every round is written
to the shared folder; nothing but two numbers per round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex that is not the smallest of its component, with the smallest one."""
    edges = saved(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        edges = saved(_small_star(_large_star(edges).distinct()).distinct(), "edges")
