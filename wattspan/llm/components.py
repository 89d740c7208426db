"""Connected components of a link table, on Spark, with tables between the rounds.

Alternating large-star and small-star rounds: every node links its larger
neighbours to its smallest one, then its smaller neighbours and itself to the
smallest. Minima are taken with partial aggregation and joined back, so a node
with very many links is never collected; each round is a written table, so a
lost executor costs one round at most. The number of rounds follows the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.llm.staging import staged


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of both directions with the smallest of u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return (
        _to_smallest(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _to_smallest(down)
    moved = found.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the component's smallest node.

    Nodes are longs. Null ends and links of a node to itself are no links;
    repeated links count once; without links the result is empty.
    """
    edges = staged(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), name
    )
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        ).first()
        if not state.n or state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        seen = state
        edges = staged(_small_star(_large_star(edges)), name)
