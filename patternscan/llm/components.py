"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import saved


def connected_components(links: DataFrame, folder: str, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``).

    ``root`` is the smallest node that links reach.  Each round ties all larger
    neighbours of a node to its smallest one, then all smaller ones to the
    smallest (large-star and small-star); the number of rounds grows with the
    logarithm of the longest path.  A round is two grouped minima and joins on
    narrow rows, written to ``folder``; a node with very many links is only ever
    aggregated with map-side partial minima and joined, never collected.  Links
    with a null end and loops are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = saved(edges.filter("u <> v").distinct(), folder, "edges-0")
    state = _state(edges)
    for k in range(1, rounds + 1):
        if not state[0]:
            break
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = saved(small.distinct(), folder, f"edges-{k}")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    """One row that changes when the edges do."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
        ).first()
    )
