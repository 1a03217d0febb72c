"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored


def component_labels(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of ``edges`` (a, b bigint).

    Every round links each node, and its larger neighbours, with the smallest node seen around it; then each node with
    the smallest of its smaller neighbours. Edges become stars after a number of rounds that grows with the logarithm
    of the longest path. The sums that decide whether to go on are all that reaches the driver. Minima are combined
    before each shuffle, so the centre of a large star is no hot key; its edges are dealt out by the other end.
    """
    now = stored(_loose(edges))
    while True:
        now, before = stored(_small_star(_large_star(now))), now
        if _digest(now) == _digest(before):
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(stars.select("label", "label").distinct()).groupBy("node").agg(F.min("label").alias("label"))


def _loose(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked with the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
