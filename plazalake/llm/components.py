"""Connected components of an edge table, by alternating star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import table


def _larger_to_min(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _smaller_to_min(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its smaller neighbours to the others and to itself."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def stars(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) but the roots: root is the smallest node
    reachable.

    Stars are contracted until the edge table no longer changes; a round at least halves the
    longest path, so ``most_rounds`` is only a guard and raises when exceeded. Edges live in shared
    tables between rounds. Null ends and loops are ignored; no edges give no rows.
    """
    now = table(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
    for _ in range(most_rounds):
        if not mark[0]:
            break
        then = table(_smaller_to_min(_larger_to_min(now)))
        seen = then.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        now, done, mark = then, seen == mark, seen
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``, roots included."""
    found = stars(edges)
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())
