"""Connected components of an edge list, by alternating large and small stars.

Nodes are any orderable values.  Every round is two joins with partial minima; the edges are
written to the shared folder after each round, so lineage stays short and a lost executor costs
one round at most.  Only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.session import settled


def _state(edges: DataFrame) -> tuple:
    hashed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), hashed).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of an edge.

    Null ends and loops are no edges; repeated edges count once; no edges give no rows.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    )
    current = settled(pairs.where("a > b").distinct())
    before = _state(current)
    while before[0]:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written down: joined as plain tables, so that adaptive execution can split a hot node
        least = settled(both.groupBy("a").agg(F.min("b").alias("m")))
        # large star: neighbours above a node move to the least of its neighbourhood
        large = (
            both.where("b > a")
            .join(least, "a", "left")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        large = settled(large)
        # small star: neighbours below a node, and itself, move to the least of them
        low = settled(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (
            large.join(low, "a", "left")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .unionAll(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        current = settled(small)
        after = _state(current)
        if after == before:
            break
        before = after
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.unionAll(roots)
