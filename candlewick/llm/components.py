"""Connected components of links, by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import kept


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and the sum of their hashes: two numbers for any number of edges."""
    mixed = F.xxhash64("hi", "lo").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.filter("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``node``, ``root`` for each node of a link: the smallest node reachable from it.

    A large star links every larger neighbour of a node to the smallest node around it; a small star links the smaller
    ones. Neither gathers a neighbourhood: both are a minimum per node and a join. Links with a null end and links of
    a node with itself are left out; no links give no rows.
    """
    edges = links.select(F.col(a).alias("hi"), F.col(b).alias("lo")).filter("hi is not null and lo is not null")
    edges = kept(_oriented(edges), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("node")).agg(F.least(F.min("lo"), F.first("hi")).alias("least"))
        large = both.join(least, both.hi == least.node).filter("lo > hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        large = large.distinct()
        lowest = large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least"))
        joined = large.join(lowest, large.hi == lowest.node)
        small = joined.select(F.explode(F.array(F.struct("hi", F.col("least").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))).alias("e"))
        edges = kept(_oriented(small.select("e.hi", "e.lo")), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return leaves.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
