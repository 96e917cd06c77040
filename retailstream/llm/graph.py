"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import stored


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours to its least neighbour (itself included).

    ``edges`` holds (u, v).  Large star looks at all neighbours of a node and
    relinks the larger ones; small star looks at the smaller ones only.
    """
    if larger_only:
        arcs = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    least = stored(least, "star-least")   # by itself in the join: a node of many links can be split
    linked = arcs.join(least, "u")
    if larger_only:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (linked.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``u, v``): the least node reachable.

    Rounds end when a large and a small star change nothing: every node then
    links straight to its least one.  Their number grows with the logarithm of
    the longest path.  Each step is a table of its own, so a lost executor
    repeats one step at most.  Self-links, repeated and null ends are ignored.
    """
    now = stored(edges.where("u != v").select("u", "v").distinct(), "star-edges")

    def digest(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = digest(now)
    if seen[0]:
        for _ in range(max_rounds):
            now = stored(_star(stored(_star(now, True), "star-large"), False), "star-small")
            found = digest(now)
            if found == seen:
                break
            seen = found
        else:
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return (now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
