"""Exact size, byte and host distributions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import thresholds as T
from ..errors import EngineError
from ..functions.urls import pool_key
from .outcomes import rate


#: Parts of a stretch that a pass of the selection counts.
BINS = 1024


def usable(w: str = "w", h: str = "h") -> Column:
    return F.coalesce((F.col(w) > 0) & (F.col(h) > 0), F.lit(False))


def side_counts(sizes: DataFrame) -> DataFrame:
    """(short_side, n): the frequency table that all size statistics come from; unusable sizes are absent."""
    return sizes.where(usable()).groupBy(F.least("w", "h").cast("long").alias("short_side")).agg(F.count("*").alias("n"))


def aspect_counts(sizes: DataFrame) -> DataFrame:
    return sizes.where(usable()).groupBy((F.col("w") / F.col("h")).alias("aspect")).agg(F.count("*").alias("n"))


def unusable_count(sizes: DataFrame) -> DataFrame:
    return sizes.agg(F.count_if(~usable()).alias("unusable"), F.count_if(usable()).alias("total"))


def sides(sizes: DataFrame) -> DataFrame:
    """short_side of the usable sizes, a row each."""
    return sizes.where(usable()).select(F.least("w", "h").cast("long").alias("short_side"))


def aspects(sizes: DataFrame) -> DataFrame:
    return sizes.where(usable()).select((F.col("w") / F.col("h")).alias("aspect"))


def ranked(rows: DataFrame, value: str, places: Callable[[int], Iterable[int]], weight: str | None = None) -> tuple[int, dict[int, float]]:
    """How many values there are, and the exact values at the places of the sorted column that `places` names for so many.

    Distributed selection: each pass counts the values in BINS equal parts of each stretch that still holds a wanted
    place, and keeps the part that does, with its least and largest value for the next pass. Tasks add up their
    own parts, so no pass shuffles or holds more than places x BINS rows, however many different values there are.
    """
    v, n = F.col(value).cast("double"), F.col(weight) if weight else F.lit(1)
    held = rows.where(F.col(value).isNotNull()).select(v.alias("v"), n.cast("long").alias("n"))
    low, high, total = held.agg(F.min("v"), F.max("v"), F.coalesce(F.sum("n"), F.lit(0))).first()
    wanted = sorted(set(places(total))) if total else []
    found: dict[int, float] = {k: low for k in wanted if low == high}
    open_: dict[tuple[float, float, int], list[int]] = {(low, high, 0): wanted} if total and low < high else {}
    while open_:
        stretches = list(open_)
        part = lambda a, b: F.least(F.floor((F.col("v") - a) / (b - a) * BINS), F.lit(BINS - 1)).cast("int")
        places_of = F.array_compact(F.array(*[F.when(F.col("v").between(a, b), F.struct(F.lit(k).alias("stretch"), part(a, b).alias("part"))) for k, (a, b, _) in enumerate(stretches)]))
        counted = held.select("v", "n", F.explode(places_of).alias("at")).groupBy("at.stretch", "at.part").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        parts = sorted(counted.collect(), key=lambda r: (r["stretch"], r["part"]))
        now: dict[tuple[float, float, int], list[int]] = {}
        for k, (_, _, before) in enumerate(stretches):
            left = open_[stretches[k]]
            for r in (r for r in parts if r["stretch"] == k):
                inside = [x for x in left if before <= x < before + r["n"]]
                if inside and r["low"] == r["high"]:
                    found |= dict.fromkeys(inside, r["low"])
                elif inside:
                    now[r["low"], r["high"], before] = inside
                before += r["n"]
        open_ = now
    return total, found


def quantiles(rows: DataFrame, value: str, shares: Iterable[float], weight: str | None = None) -> list[float | None]:
    """Exact quantiles by linear interpolation at (n - 1) x share; NULLs where there is no value."""
    shares = list(shares)

    def ends(at: float) -> tuple[int, int]:
        return math.floor(at), math.ceil(at)

    total, found = ranked(rows, value, lambda n: [k for s in shares for k in ends((n - 1) * s)], weight)
    if not total:
        return [None] * len(shares)
    out = []
    for s in shares:
        at = (total - 1) * s
        a, b = (found[k] for k in ends(at))
        out.append(a + (b - a) * (at - math.floor(at)))
    return out


def percentiles(rows: DataFrame, value: str, ladder: tuple[int, ...] = T.PERCENTILES) -> DataFrame:
    """(p, value) by linear interpolation at (n - 1) p / 100; exact. rows holds the values, or each value once with its count n."""
    got = quantiles(rows, value, [p / 100 for p in ladder], "n" if "n" in rows.columns else None)
    return rows.sparkSession.createDataFrame([(p, v) for p, v in zip(ladder, got) if v is not None], f"p long, `{value}` double")


def _weight(rows: DataFrame) -> Column:
    """n of a frequency table; 1 where each value has a row of its own."""
    return F.col("n") if "n" in rows.columns else F.lit(1)


def below(counts: DataFrame, ladder: tuple[int, ...] = T.SIDE_LADDER) -> DataFrame:
    """(threshold, below, fraction): short sides strictly under each threshold, of the usable ones."""
    n = _weight(counts)
    aggs = [F.coalesce(F.sum(F.when(F.col("short_side") < t, n)), F.lit(0)).cast("long") for t in ladder]
    got = counts.agg(F.array(*aggs).alias("b"), F.sum(n).alias("total"))
    each = got.select(F.explode(F.arrays_zip(F.array(*[F.lit(t) for t in ladder]).alias("t"), F.col("b"))).alias("x"), "total")
    return each.select(F.col("x.t").cast("long").alias("threshold"), F.col("x.b").alias("below"), rate(F.col("x.b"), "total").alias("fraction"))


def within(counts: DataFrame, bands: tuple[tuple[float, float], ...]) -> DataFrame:
    """(low, high, fraction) of aspects in each band, both ends included."""
    n = _weight(counts)
    aggs = [F.struct(F.lit(a).alias("low"), F.lit(b).alias("high"), F.sum(F.when(F.col("aspect").between(a, b), n).otherwise(0)).alias("hit")) for a, b in bands]
    got = counts.agg(F.array(*aggs).alias("x"), F.sum(n).alias("total"))
    return got.select(F.explode("x").alias("x"), "total").select("x.low", "x.high", rate(F.col("x.hit"), "total").alias("fraction"))


def degenerate(counts: DataFrame) -> DataFrame:
    """Share under DEGENERATE_SIDE pixels, and whether that's worth a note (V8)."""
    got = below(counts, (T.DEGENERATE_SIDE,))
    return got.select("fraction", F.coalesce(F.col("fraction") > T.DEGENERATE_SHARE, F.lit(False)).alias("noted"))


def even_sample(total: int, want: int) -> list[int]:
    """The positions that evenly_sampled() keeps: as many as wanted, at equal distances from the first to the last (H2)."""
    if want < 1:
        raise EngineError("a sample has to have at least one place")
    many = max(0, min(want, total))
    return np.rint(np.arange(many) * (total - 1) / max(1, many - 1)).astype(int).tolist()


def evenly_sampled(rows: DataFrame, position: str, total: int, want: int) -> DataFrame:
    """The rows at even_sample()'s positions, worked out from each row's own position; no list is joined."""
    if want <= 0:
        raise EngineError("a sample has to have at least one place")
    p = F.col(position)
    if want >= total:
        return rows
    if want == 1:
        return rows.where(p == 0)
    step = (total - 1) / (want - 1)
    near = F.floor(p / step)
    return rows.where(F.greatest(*[(F.bround((near + d) * F.lit(total - 1) / F.lit(want - 1)).cast("long") == p) & (near + d).between(0, want - 1) for d in (0, 1)]))


def arrived(samples: DataFrame) -> DataFrame:
    """One row: succeeded, failed, resized of samples (status, w, h, ow, oh)."""
    ok = F.coalesce((F.col("status").isNull() | (F.col("status") == "success")) & (F.col("ow") != 0) & (F.col("oh") != 0), F.lit(False))
    kept = F.struct("w", "h").eqNullSafe(F.struct(F.col("ow").alias("w"), F.col("oh").alias("h")))
    return samples.agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.count_if(ok & ~kept).alias("resized"))


def median_drift(claimed: DataFrame, actual: DataFrame) -> DataFrame:
    """Joins two (p, short_side) ladders on p; drift of the arrived value from the claimed one."""
    both = claimed.withColumnRenamed("short_side", "claimed").join(actual.withColumnRenamed("short_side", "arrived"), "p")
    return both.select("p", "claimed", "arrived", rate(F.abs(F.col("arrived") - F.col("claimed")), "claimed").alias("drift"))


def shard_sizes(shards: DataFrame) -> DataFrame:
    """(task, shard, bytes, successes) with bytes_per_image, NULL without a success."""
    return shards.withColumn("bytes_per_image", F.when(F.col("successes") > 0, F.col("bytes") / F.col("successes")))


def task_sizes(shards: DataFrame) -> DataFrame:
    """Per task: total bytes over total images of usable shards, smallest and largest shard, spread."""
    good = shard_sizes(shards).where("successes > 0")
    out = good.groupBy("task").agg(F.count("*").alias("shards"), F.sum("bytes").cast("long").alias("bytes"), F.sum("successes").cast("long").alias("images"), F.min("bytes_per_image").alias("smallest"), F.max("bytes_per_image").alias("largest"))
    return out.withColumns({"bytes_per_image": rate("bytes", "images"), "spread": rate("largest", "smallest")})


def size_report(tasks: DataFrame) -> DataFrame:
    """One row: spread between tasks against the worst within one (G15, V10); ties: the first smallest, the last largest."""
    got = tasks.agg(
        F.min(F.struct("bytes_per_image", "task")).alias("lo"), F.max(F.struct("bytes_per_image", "task")).alias("hi"), F.max("spread").alias("worst_within"), F.count("*").alias("tasks")
    )
    between = rate("hi.bytes_per_image", "lo.bytes_per_image")
    return got.select("tasks", F.col("lo.task").alias("smallest_task"), F.col("hi.task").alias("largest_task"), between.alias("between"), "worst_within", F.coalesce(between > F.col("worst_within"), F.lit(False)).alias("between_dominates"))


def host_concentration(urls: DataFrame, window: int = T.HOST_WINDOW, pos: str = "pos", url: str = "url") -> DataFrame:
    """One row: connections needed with a pool for each window of URLs (G16, G17, V9). Exact distinct counts."""
    if window <= 0:
        raise EngineError("a window has to hold at least one URL")
    keyed = urls.select(F.expr(f"{pos} div {int(window)}").alias("win"), pool_key(F.col(url)).alias("key"))
    # windows of each key from one grouping; a hot key is added up where it is read
    per = keyed.groupBy("win", "key").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("windows"))
    named = F.col("key").isNotNull()
    out = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("urls"), F.coalesce(F.sum(F.when(named, F.col("windows"))), F.lit(0)).cast("long").alias("connections"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).cast("long").alias("unparseable"), F.count_if(named).alias("hosts"),
    )
    fetchable = F.col("urls") - F.col("unparseable")
    return out.select(
        "urls", "connections", "unparseable", "hosts",
        F.coalesce(rate(fetchable, "connections"), F.lit(1.0)).alias("reuse_factor"),
        F.coalesce(1 - rate("connections", fetchable), F.lit(0.0)).alias("saved_fraction"),
        F.coalesce(rate(fetchable, "connections") >= T.POOLING_REUSE, F.lit(False)).alias("pool"),
    )


def top_hosts(urls: DataFrame, k: int, pos: str = "pos", url: str = "url") -> DataFrame:
    """(host, n, first) of the k most frequent pool keys, ties in order of first sight."""
    named = urls.select(F.col(pos).alias("pos"), pool_key(F.col(url)).alias("host")).where("host IS NOT NULL")
    return named.groupBy("host").agg(F.count("*").alias("n"), F.min("pos").alias("first")).orderBy(F.desc("n"), "first").limit(k)


def caption_mismatches(samples: DataFrame, captions: DataFrame) -> DataFrame:
    """Samples whose caption differs from the recorded one of the same task and key; absent records aren't compared.

    Digests are compared first, so only the captions of keys that differ are read a second time and joined.
    """
    digest = lambda df: df.select("task", "key", F.sha2("caption", 256).alias("h"))
    told = digest(captions).withColumnRenamed("h", "said")
    differ = digest(samples).join(told, ["task", "key"]).where(F.col("said").isNotNull() & ~F.col("h").eqNullSafe(F.col("said")))
    differ = differ.select("task", "key").distinct().persist()  # its size decides how it is joined; lost parts are computed again
    differ.count()
    ours, theirs = (df.join(differ, ["task", "key"], "left_semi") for df in (samples, captions.withColumnRenamed("caption", "recorded")))
    return ours.join(theirs, ["task", "key"]).where(F.col("recorded").isNotNull() & ~F.col("caption").eqNullSafe(F.col("recorded")))


