"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import stored

MOST_ROUNDS = 50


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``: the smallest node reachable from each node of an edge.

    ``edges`` has two long columns ``a`` and ``b``. Alternates the large-star
    and small-star steps until the edges form stars: each step hands every
    node's neighbours its smallest neighbour. Minima are combined before they
    are shuffled, the one join per step is split by adaptive execution at a hub,
    and every round's edges are written to the shared folder.
    """
    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(edges.distinct(), "components")
    before = None
    for _ in range(MOST_ROUNDS):
        # large star: neighbours above a node go to its smallest neighbour or itself
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        least = stored(least, "components")  # so that the join can split a hub
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        large = stored(large, "components")
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        low = stored(low, "components")
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .where("a != b")
            .distinct()
        )
        edges = stored(small, "components")
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
