"""A running total of outcomes while shards are still being written: the re-scanning report as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.status import BUCKETS, bucket

STATS = "count long, successes long, status_dict map<string, bigint>"


def outcome_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Streams *_stats.json files of a folder tree as (bucket, n) totals; write it in complete mode."""
    stats = spark.readStream.schema(STATS).option("recursiveFileLookup", True).option("pathGlobFilter", "*_stats.json").option("multiLine", True).json(folder)
    messages = stats.select(F.explode("status_dict").alias("message", "n"))
    return messages.groupBy(bucket(F.col("message")).alias("bucket")).agg(F.sum("n").alias("n"))


__all__ = ["BUCKETS", "STATS", "outcome_stream"]
