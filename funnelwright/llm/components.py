"""Connected components of a graph of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of links ``a``, ``b``.

    Kiveris and others: Connected Components in MapReduce and Beyond (2014). Each
    round is stored, so nothing grows in the plan; the number of rounds follows
    the logarithm of the longest chain. Single nodes have no row.
    """
    edges = (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = stored(edges, f"{name}-0")
    state, round_ = _state(edges), 0
    while state[0]:
        round_ += 1
        edges = stored(_small_star(_large_star(edges)), f"{name}-{round_}")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
