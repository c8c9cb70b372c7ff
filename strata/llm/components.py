"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every node links its larger
neighbours, then its smaller ones, to the smallest node it knows, until each
component is a star around its smallest node.  Each round is two aggregations
(combined before their shuffle) and two joins of freshly read tables, so a hub
with any number of neighbours is split by adaptive execution.  Rounds are
written to the shared folder; nothing of the graph comes to the driver but
two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (a > b); gives edges of the same form."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    seen = down.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else down
    low = materialise(seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star")
    joined = seen.join(low, "u")
    if large:
        linked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return materialise(linked.filter("a > b").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge of (a, b), both long and not null;
    root is the smallest node of the component.  Loops and repeats are ignored."""
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a > b").distinct(), "edges")
    state = _state(now)
    while True:
        now = _star(_star(now, large=True), large=False)
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
