"""Connected components of a link table that may have hubs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import join_split, remove, stored_at


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = join_split(both.filter("v > u"), least, ["u"])
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_split(edges, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.filter("u <> v").union(kept).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(a, b)`` links of whole numbers -> ``(node, root)`` with the smallest node as root.

    Alternates the large-star and small-star steps until no link moves; the number of rounds grows
    with the logarithm of the longest chain. Each round is written to the shared folder and the one
    before it removed. A hub is a join key with many rows, which AQE splits; the minima are combined
    before the shuffle. Nodes without a link do not appear; null ends and self-links are ignored.
    """
    spark = edges.sparkSession
    pairs = edges.filter("a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    )
    now, path = stored_at(pairs.distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        # One row: how many links there are and a sum that changes when any of them moves.
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == mark or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = state
        after, next_path = stored_at(_small_star(_large_star(now)), "links")
        remove(spark, path)
        now, path = after, next_path
    raise RuntimeError(f"links still move after {most_rounds} rounds")
