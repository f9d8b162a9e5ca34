"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, centre: str, other: str) -> DataFrame:
    """``(other, lowest)``: the lowest node among a centre and its others, for each of its others."""
    lowest = edges.groupBy(centre).agg(F.min(other).alias("least_other")).select(centre, F.least(centre, "least_other").alias("lowest"))
    return edges.join(lowest, centre)


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``: the smallest node that links reach, itself included.

    Every round ties each node's larger neighbours, then its smaller ones, to the smallest; the number of rounds grows with
    the logarithm of the longest path. Rounds are written out, so plans stay short. Loops and repeated links do no harm.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        large = _star(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("lowest").alias("b"))
        large = large.where("a <> b").distinct()
        small = _star(large, "a", "b")
        small = small.select(F.col("b").alias("a"), F.col("lowest").alias("b")).union(small.select("a", F.col("lowest").alias("b")))
        edges = materialize(small.where("a <> b").distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
