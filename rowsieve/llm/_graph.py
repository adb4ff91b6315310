"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm._shared import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; a component is named by its least id.

    Every round replaces links by links to the least neighbour, first from the larger
    side, then from the smaller, until nothing changes: the number of rounds grows with
    the logarithm of the size. All that meets of an id is a minimum, added up before each
    shuffle; the links themselves are only ever joined with it, where adaptive execution
    splits an id with very many links. Each round is staged.
    """

    def both_ways(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def to_least(near: DataFrame) -> DataFrame:
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        return near.join(least, "a")

    def size(edges: DataFrame) -> tuple:
        row = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        return row["n"], row["sum"]

    edges = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    before = size(edges)
    while before[0]:
        near = to_least(both_ways(edges))
        edges = near.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = edges.where("a <> b").distinct()
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = to_least(down)
        own = near.select("a", F.col("least").alias("b"))
        moved = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = staged(own.unionByName(moved).where("a <> b").distinct(), "links")
        now = size(edges)
        if now == before:
            break
        before = now
    named = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return named.unionByName(roots).distinct()
