"""Choosing rows: first and last wins, top one, ties, occurrences, unique values."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ``order`` must be total for a repeatable choice."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by columns; one hash aggregate instead of a sort."""
    rest = [c for c in df.columns if c not in key]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*key).agg(packed).select(*key, *(F.col(f"_r.`{c}`").alias(c) for c in rest)).select(*df.columns)


def top1_or_null_on_tie(df: DataFrame, part: list[str], score: list[Column], value: str) -> DataFrame:
    """The value of the best-scored row of each part, NULL where several rows share the best score."""
    ranked = df.withColumn("_r", F.rank().over(Window.partitionBy(*part).orderBy(*score))).where("_r = 1")
    one = F.count("*") == 1
    return ranked.groupBy(*part).agg(F.when(one, F.first(value)).alias(value))


def numbered(df: DataFrame, order: list[Column], name: str, folder: str | None = None) -> DataFrame:
    """Numbers rows from 1 in order. No task gets more than its range of them.

    Rows are sorted by ranges and written to the shared folder once, so that
    the numbers within a range and the counts of the ranges are of one and the
    same sort; there is one count a range. The rows stay in a new folder below
    ``folder`` (a run's scratch folder, say) for as long as they are used.
    """
    from ..session import shared_dir

    spark = df.sparkSession
    path = f"{folder}/numbered-{uuid.uuid4().hex}" if folder else shared_dir(spark)
    df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_m", 33))
    counts = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    placed = rows.join(F.broadcast(before), "_range")
    return placed.withColumn(name, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).select(*df.columns, name)


def occurrence(df: DataFrame, identity: list[str], order: list[Column], name: str = "occurrence", base: int = 1) -> DataFrame:
    """Numbers equal rows, so that duplicates stay apart."""
    n = F.row_number().over(Window.partitionBy(*identity).orderBy(*order))
    return df.withColumn(name, (n + (base - 1)).cast("bigint"))


def unique_or_null(df: DataFrame, part: list[str], value: str, name: str | None = None) -> DataFrame:
    """One row per part: its only distinct non-null value, else NULL.

    Least and greatest value are enough to tell, so no set is collected.
    """
    low, high = F.min(value), F.max(value)
    return df.groupBy(*part).agg(F.when(low == high, low).alias(name or value))


def inherit_unique(df: DataFrame, part: list[str], value: str) -> DataFrame:
    """Fills NULLs with the part's only distinct value, where there is just one."""
    return df.join(unique_or_null(df, part, value, "_u"), part, "left").withColumn(value, F.coalesce(F.col(value), F.col("_u"))).drop("_u")


def first_last_around(df: DataFrame, key: str, when: str, as_of: Column) -> DataFrame:
    """Per key: last value up to ``as_of``, next one after it, and the row count, in one aggregate."""
    c = F.col(when)
    return df.groupBy(key).agg(F.max(F.when(c <= as_of, c)).alias("last_value"), F.min(F.when(c > as_of, c)).alias("next_value"), F.count("*").alias("entries"))
