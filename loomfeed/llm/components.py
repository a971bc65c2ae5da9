"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id in ``edges`` (a, b).

    Each round moves every node to the neighbour, or itself, that comes first in a hashed order
    and joins the moved edges; the hash keeps long chains from shrinking one node at a time.
    Minima are partly combined before the shuffle, so a hub costs one row per task; the joins read
    written tables, whose hot keys Spark splits. Nothing but a row count reaches the driver.
    """
    spark = edges.sparkSession
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = stage(edges.select(a, b).where("a < b").distinct(), "edges")
    first = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    moves: DataFrame | None = None
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min(first("b")).alias("least"))
        step = stage(
            step.select("a", F.least(first("a"), F.col("least"))["id"].alias("to")), "moves"
        )
        to_b = step.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(step, "a").join(to_b, "b")
        left = stage(
            moved.select(F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b"))
            .where("a < b")
            .distinct(),
            "edges",
        )
        if moves is None:
            moves = step.select(F.col("a").alias("id"), "to")
        else:
            later = step.select(F.col("a").alias("to"), F.col("to").alias("next"))
            moves = moves.join(later, "to", "left").select(
                "id", F.coalesce("next", "to").alias("to")
            )
    if moves is None:
        return spark.createDataFrame([], "id long, component long")
    moves = stage(moves, "roots")
    least = stage(moves.groupBy("to").agg(F.min("id").alias("component")), "least")
    return moves.join(least, "to").select("id", "component")
