"""What depends on what: edges followed to a fixed point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.parquet import staged


def downstream(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Every ``node`` reached from ``start`` along ``edges`` (``source, target``) with its depth (C-7).

    Each round joins only the nodes found last and is staged, so the plan does not grow with the depth.
    A node is found once, at its smallest depth; cycles end by themselves.
    """
    frontier = staged(start.select("node").distinct().withColumn("depth", F.lit(0)), "impact")
    found, depth = frontier, 0
    while not frontier.isEmpty():
        depth += 1
        next_nodes = (
            frontier.join(edges, F.col("node") == F.col("source"))
            .select(F.col("target").alias("node"))
            .distinct()
            .join(found, "node", "left_anti")
        )
        frontier = staged(next_nodes.withColumn("depth", F.lit(depth)), "impact")
        found = found.union(frontier)
    return found
