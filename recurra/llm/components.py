"""Connected components of a graph given as a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.session import cut_lineage


def _smallest_neighbour(pairs: DataFrame) -> DataFrame:
    """For every `a` of (a, b): the smallest of a and its neighbours. Sums up before it moves, so hubs are one row a task."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.where("b > a").join(_smallest_neighbour(both), "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _smallest_neighbour(down)
    return down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))


def _proper(links: DataFrame) -> DataFrame:
    return links.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), both bigint; root is the component's smallest node.

    Each round is a few grouped aggregates and joins on the links alone, written to the shared folder; the number of rounds
    grows with the logarithm of the longest chain. Null ends and links of a node to itself are left out. No links: no rows.
    """
    links = cut_lineage(_proper(links.select("a", "b").where("a is not null and b is not null")))
    state = _state(links)
    while state[0]:
        links = cut_lineage(_proper(_small_star(_proper(_large_star(links)))))
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
