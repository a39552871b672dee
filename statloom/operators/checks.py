"""Constraints as frames of violations, and rows split into good ones and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def rules(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The rows with ``reason``: the first rule that does not hold, NULL for good rows."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(checks.items()):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason)


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason): no row is lost."""
    judged = rules(df, checks)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def pattern(column: str, regex: str) -> Column:
    return F.col(column).rlike(regex)


def enum(column: str, values: list[str]) -> Column:
    return F.col(column).isin(values)


def reconcile(totals: DataFrame, parts: DataFrame, key: str, expected: str, actual: str) -> DataFrame:
    """Keys whose parts do not add up to their total; one blank part is inferred where it explains the gap."""
    sums = parts.groupBy(key).agg(F.sum(actual).alias("_sum"), F.count_if(F.col(actual).isNull()).alias("_blank"))
    rows = totals.join(sums, key, "left").withColumn("retrieved", F.coalesce("_sum", F.lit(0)))
    gap = F.col(expected) - F.col("retrieved")
    return rows.select(key, expected, "retrieved", F.when((F.col("_blank") == 1) & (gap >= 0), gap).alias("inferred"), ((gap == 0) & (F.coalesce("_blank", F.lit(0)) == 0)).alias("balanced"))
