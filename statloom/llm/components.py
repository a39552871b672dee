"""Connected components by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join on (node, neighbour) rows. A hub's
rows meet its one minimum in the join and are streamed there, or are split by
adaptive execution; no task holds them. Rounds are cut by a table written to the
scratch folder, which also gives their shuffle files back, and the number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, delete


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Ties each node's larger (or smaller and own) neighbours to its least neighbour."""
    if larger:
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    rows = joined.where("b > a") if larger else joined.where("b != m")
    out = rows.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not larger:
        out = out.unionByName(least.where("a != m").select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(spark: SparkSession, links: DataFrame, max_rounds: int = 60, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is the least node of it."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    scratch, run, before = scratch or Scratch(spark), uuid.uuid4().hex, None
    pairs = scratch.written(pairs, f"{run}/links")
    for k in range(max_rounds):
        pairs = scratch.written(_star(_star(pairs, True), False), f"{run}/round{k}")
        if k:
            delete(spark, f"{scratch.path}/{run}/round{k - 1}")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
