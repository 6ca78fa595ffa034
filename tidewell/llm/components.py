"""Connected components of a distributed edge table (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import checkpointed


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    other = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(other).where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of an edge; a component is named by its least node.

    Each round halves paths, so rounds grow with the logarithm of a component's
    length; every round is checkpointed, so the plan stays short and a lost
    executor costs one round.  No edge or label reaches the driver.  A star's
    centre is one key of the join with one row on its other side, which the
    adaptive planner splits where it is skewed; minima combine before they
    shuffle.  Loops and edges with a null end are ignored.
    """
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = checkpointed(now.distinct())
    before = None
    while before != (state := _state(now)):
        before = state
        if not state[0]:
            break
        now = checkpointed(_small_star(_large_star(now)))
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
