"""Connected components by alternating stars: each round is two joins, nothing goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node that can be reached.

    Edges join values of one orderable type; loops and repeats do no harm, null ends are ignored.
    Each round is written to the shared folder. The number of rounds grows with the logarithm of the
    longest chain; a hot node is aggregated before it is exchanged, and its edges are spread by
    Spark's handling of skewed joins.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = written(now.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    seen = _signature(now)
    while seen[0]:
        now = written(_small_star(_large_star(now)), "edges")
        new = _signature(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
