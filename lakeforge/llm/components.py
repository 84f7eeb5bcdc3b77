"""Connected components of an edge table by alternating large and small stars.

Every step is a join and an aggregate over edges; no component is ever gathered in one
place: the joins are sort-merge joins of two plain exchanges, which adaptive execution
splits where a hub has most of the edges. Each round is written to the shared folder, so
lost executors cost one round; the round before is deleted then.

Defined results: rows with a null end are left out; repeated edges and loops change
nothing; no edges give no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # For the small star ``a`` is the larger end, so all its neighbours are smaller.
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    moved = joined.where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for all nodes of the edges ``a, b`` but the components' smallest."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        before, now = now, materialize(_star(_star(now, True), False), "edges")
        discard(before)
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = mark
