"""Connected components by alternating large-star and small-star steps.

A step replaces edges by edges to the smallest known neighbour and never adds any, so the edge table only shrinks. Each
round is written to the shared folder. Nothing but one line of sums per round comes back to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import run_dir, stored


def _to_smallest(neighbours: DataFrame) -> DataFrame:
    """``u, v, m``: m is the smallest of u and its neighbours. The minimum is taken map-side before the exchange."""
    lowest = neighbours.groupBy("u").agg(F.min("v").alias("m"))
    lowest = lowest.select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    return neighbours.join(lowest, F.col("u") == F.col("of")).drop("of")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _to_smallest(down)
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, path: str | None = None, about: int | None = None) -> DataFrame:
    """``u, root`` for every node of ``edges (u, v)`` with another root than itself: the smallest node it can reach.

    Self-loops and repeated edges change nothing; no edges give no rows. ``about`` how many edges to expect, if known.
    """
    path = path or run_dir(edges.sparkSession, "components")
    ordered = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(ordered.distinct(), f"{path}/0", about)
    before, round_ = None, 0
    while True:
        sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sums[0] == 0 or tuple(sums) == before:
            return now.select("u", F.col("v").alias("root"))
        before, round_ = tuple(sums), round_ + 1
        now = stored(small_star(large_star(now)), f"{path}/{round_}", sums[0])
