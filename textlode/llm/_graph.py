"""Connected components by alternating large-star and small-star rounds.

Every round replaces edges by edges to smaller neighbours and is written to
the shared folder, so nothing is gathered on the driver and a lost executor
costs one round.  A chain of n nodes takes O(log n) rounds, a star one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Scratch


def _measures() -> dict:
    return {"n": F.count(F.lit(1)), "mark": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}


def roots(forest: DataFrame, work: Scratch, label: str) -> DataFrame:
    """(node, root) of a forest given as (node, parent), one row per node that has a parent.

    Each round a node takes its parent's parent, so depth d takes log2(d)
    rounds.  Roots are their own.
    """
    now = work.keep(forest, f"{label}-0")
    k, moved = 0, 1
    while moved:
        k += 1
        above = now.select(F.col("node").alias("p"), F.col("parent").alias("up"))
        jumped = now.join(above, F.col("parent") == F.col("p"), "left").select("node", F.coalesce("up", "parent").alias("parent"), F.col("up").isNotNull().alias("moved"))
        now, seen = work.keep_observed(jumped, f"{label}-{k}", moved=F.count_if("moved"))
        now, moved = now.drop("moved"), seen["moved"]
        work.drop(f"{label}-{k - 1}")
    tops = now.select(F.col("parent").alias("node")).distinct()
    return now.select("node", F.col("parent").alias("root")).union(tops.select("node", F.col("node").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, work: Scratch, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns); root is the smallest node reachable.

    Self-loops and repeated edges are allowed; no edges give no rows.
    """
    a, b = edges.columns
    start = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    now, state = work.keep_observed(start, f"{label}-0", **_measures())
    k, before = 0, None
    while state["n"] and state != before:
        k += 1
        before = state
        now, state = work.keep_observed(_small_star(_large_star(now)), f"{label}-{k}", **_measures())
        work.drop(f"{label}-{k - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
