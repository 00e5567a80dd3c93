"""Connected components by alternating stars (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import stored

#: Edges of a task; fewer edges are dealt to fewer tasks.
EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in edges (a, b).

    Each round connects the larger neighbours of a node to its smallest one, then
    the smaller ones. Minima are aggregated before anything is shuffled, and joins are
    between stored tables, so that a node with very many neighbours can be split.
    Rounds end as soon as the edges are stars; edges that are stars from the start take none.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    parts = 1 + 2 * edges.count() // EDGES
    few = parts < int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def held(rows: DataFrame, name: str) -> DataFrame:
        return stored(rows.coalesce(parts) if few else rows, name)

    while not _stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = held(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = held(large.union(edges.join(least, "a").select("a", F.col("m").alias("b"))).distinct(), "large-star")
        least = held(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = held(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
    # Every edge now leads to the smallest node of its component.
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Every node has one edge to a smaller one, which has none itself. `edges` (a, b) are distinct, with a > b."""
    sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    sides = sides.union(edges.select("b", F.lit(0), F.lit(1)))
    ups = sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ups.where("up > 1 OR up > 0 AND down > 0").isEmpty()
