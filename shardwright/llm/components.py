"""Connected components by alternating large-star and small-star rounds.

Each round is a few equi-joins and minimum aggregates over the edges, so no component is gathered anywhere. A hub's
edges meet in a join that adaptive execution can split. Lineage is cut by a table in the shared folder every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _least_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))


def _star(edges: DataFrame) -> DataFrame:
    """One large-star, then one small-star; edges as (u, v)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.join(_least_of(both), "u").where("v > u AND v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = _least_of(down)
    small = down.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (u long, v long), either way round -> (u, component) for every node but the least of each component."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        was, mark = mark, now.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(u, v) AS decimal(38, 0))"))).first()
        if was == mark or not mark[0]:
            return now.select("u", F.col("v").alias("component"))
        before, now = now, written(_star(now), "edges")
        dropped(before)
