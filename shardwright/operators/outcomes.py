"""Failure classification and run summaries.

Message counts are one row per (keys, message); maps of messages are exploded once and never summed with the columns
beside them. All aggregates are partial sums, so a task with a third of all shards isn't gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import BUCKETS, bucket, rate_limited

COUNTERS = (*BUCKETS, "rate_limited", "total")


def exploded(stats: DataFrame, *keys: str) -> DataFrame:
    """(keys, message, n) of statistics with a map status_dict; a NULL map adds nothing."""
    return stats.select(*keys, F.explode("status_dict").alias("message", "n"))


def failure_counts(messages: DataFrame, *keys: str, n: str = "n") -> DataFrame:
    """Counters of each key; total includes successes, rate_limited overlaps transient."""
    marked = messages.select(*keys, bucket(F.col("message")).alias("b_"), rate_limited(F.col("message")).alias("r_"), F.col(n).alias("n_"))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n_"))), F.lit(0)).cast("long")
    sums = [count(F.col("b_") == b).alias(b) for b in BUCKETS]
    return marked.groupBy(*keys).agg(*sums, count(F.col("r_")).alias("rate_limited"), count(F.lit(True)).alias("total"), count(F.col("b_") == "success").alias("succeeded"))


def merged_messages(messages: DataFrame) -> DataFrame:
    """(message, n, first): counts over all shards and where a message was first seen."""
    return messages.groupBy("message").agg(F.sum("n").cast("long").alias("n"), F.min("pos").alias("first"))


def most_common(merged: DataFrame, k: int) -> DataFrame:
    """The k most frequent; ties in order of first sight."""
    return merged.orderBy(F.desc("n"), F.asc("first")).limit(k)


def run_summary(stats: DataFrame, messages: DataFrame, *keys: str) -> DataFrame:
    """candidates and successes of the statistics' own columns, with the counters of their messages."""
    top = stats.groupBy(*keys).agg(F.sum("count").cast("long").alias("candidates"), F.sum("successes").cast("long").alias("successes"))
    counts = failure_counts(messages, *keys).drop("succeeded")
    out = top.join(counts, list(keys), "left")
    return out.select(*keys, "candidates", "successes", *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS))


def rate(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL where b is 0 or unknown."""
    up, down = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(up.cast("double"), down.cast("double"))


def with_rates(summary: DataFrame, wall: str | None = None) -> DataFrame:
    out = summary.withColumns({
        "yield_rate": rate("successes", "candidates"),
        "dns_fraction": rate("dns", "candidates"),
        "unreachable_fraction": rate("unreachable", "candidates"),
        "rate_limited_fraction": rate("rate_limited", "candidates"),
    })
    return out if wall is None else out.withColumn("successes_per_sec", F.when(F.col(wall) > 0, rate("successes", wall)))
