"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialised


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge to another.

    Alternates two steps until nothing changes: each node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Both keep the
    components, and they end with every node pointing at its smallest one after a
    number of rounds that grows with the logarithm of the size. Every round is
    two shuffles, its result is written to the shared folder, and only two sums
    come to the driver. A node with very many edges is a group whose minimum is
    taken on the map side, and a join key that adaptive execution splits.
    Self-loops, repeated edges and NULL nodes count for nothing.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    state = materialised(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = _sums(state)
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        state = materialised(
            larger.join(smallest, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = _sums(state)
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _sums(state: DataFrame) -> tuple[int, int]:
    """Count and order-free checksum of the edges."""
    row = state.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]
