"""New capture files, once each, into year partitions.

A stream with an available-now trigger keeps track of the files that were
read, by name: new captures come in new files (``content`` notices rewritten
ones). Each micro-batch goes through the same plans as a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..plans import calendar
from ..session import Scratch
from ..sources.sinks import exists, replace_years
from .content import _days


def refresh_calendar(spark: SparkSession, folder: str, target: str, quarantine: str, checkpoint: str) -> None:
    """Replaces the days that the ranges of new capture files cover; all other days stay as they are.

    A batch that is run again writes the same rows to the same places.
    """

    def apply(batch: DataFrame, number: int) -> None:
        ranges = batch.select("from", "to").distinct()
        span = ranges.agg(F.min(F.substring("from", 1, 4)).cast("int"), F.max(F.substring("to", 1, 4)).cast("int")).first()
        if span[0] is None:
            return
        scratch = Scratch(spark)
        good, bad = calendar.parsed(batch)
        rows = good.withColumn("year", F.substring("publish_date", 1, 4).cast("int"))
        if exists(spark, target):
            # Days outside of these ranges, of the years that are written anew.
            old = spark.read.parquet(target).where(F.col("year").between(span[0], span[1]))
            days = _days(ranges).select(F.col("day").alias("publish_date")).distinct()
            held = old.join(days, "publish_date", "left_anti")
            rows = rows.unionByName(held.select(*rows.columns))
        replace_years(scratch.written(rows, "years"), target, span[0], span[1])
        bad.write.mode("overwrite").json(f"{quarantine}/batch={number}")
        scratch.drop()

    pages = spark.readStream.schema(schemas.CAPTURE).json(folder)
    stream = pages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def windowed_counts(events: DataFrame, when: str, late: str, width: str, key: str) -> DataFrame:
    """Counts per window and key of a stream of timestamped rows, late rows let in for ``late``."""
    return events.withWatermark(when, late).groupBy(F.window(when, width), key).agg(F.count("*").alias("n"))
