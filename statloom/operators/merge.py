"""Publication state: per-key status, refresh of selected sources, carried failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRESH, RETAINED, FAILED, NO_LONGER_LISTED = "fresh", "retained", "failed", "no_longer_listed"


def status_merge(documents: DataFrame, discovered: DataFrame, failures: DataFrame, previous: DataFrame, key: str, discovery_complete: bool) -> DataFrame:
    """(key, status, error) for every key that is discovered, failed, new or held from before.

    ``failures`` has (key, error); the other frames need only the key.
    """
    d = documents.select(key, F.lit(True).alias("_doc")).dropDuplicates([key])
    s = discovered.select(key).unionByName(documents.select(key)).unionByName(failures.select(key)).dropDuplicates().withColumn("_seen", F.lit(True))
    f = failures.groupBy(key).agg(F.min("error").alias("error"))
    p = previous.select(key, F.lit(True).alias("_old")).dropDuplicates([key])
    rows = s.join(p, key, "full_outer").join(d, key, "left").join(f, key, "left")
    fresh = F.col("_doc").isNotNull() & F.col("error").isNull()
    gone = F.col("_seen").isNull() & F.lit(discovery_complete)
    status = F.when(fresh, FRESH).when(gone, NO_LONGER_LISTED).when(F.col("_old").isNotNull(), RETAINED).otherwise(FAILED)
    return rows.select(key, status.alias("status"), F.when(~fresh, F.col("error")).alias("error"))


def completeness(statuses: DataFrame, discovered: DataFrame, key: str, discovery_complete: bool) -> DataFrame:
    """One row: complete only if something was discovered and every discovered key is fresh without error."""
    rows = discovered.select(key).dropDuplicates().join(statuses, key, "left")
    good = F.coalesce((F.col("status") == FRESH) & F.col("error").isNull(), F.lit(False))
    return rows.agg((F.coalesce(F.bool_and(good), F.lit(False)) & F.lit(discovery_complete)).alias("complete"), F.count("*").alias("discovered_count"))


def refresh_merge(fresh: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Fresh rows and the held rows whose key was not refreshed."""
    return fresh.unionByName(held.join(fresh.select(*key).dropDuplicates(), key, "left_anti"))


def carry_failures(current: DataFrame, earlier: DataFrame, attempted: DataFrame, key: list[str]) -> DataFrame:
    """Failures of this run, and earlier ones of keys that this run did not try."""
    return current.unionByName(earlier.join(attempted.select(*key).dropDuplicates(), key, "left_anti"))
