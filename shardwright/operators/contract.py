"""Contracts of shards and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import thresholds as T

REQUIRED = ("count", "successes", "failed_to_download", "failed_to_resize", "status_dict")


def stats_problems(raw: DataFrame, body: str = "raw") -> DataFrame:
    """The first violation of each statistics text, NULL if it holds. A missing key isn't a NULL value."""
    top = F.from_json(F.col(body), "map<string,string>")
    out = raw.withColumn("top_", top).withColumn("st_", F.from_json(F.col("top_")["status_dict"], "map<string,bigint>"))
    number = lambda k: F.col("top_")[k].try_cast("double").try_cast("long")
    spent = number("successes") + number("failed_to_download") + number("failed_to_resize")
    said = F.coalesce(F.try_element_at("st_", F.lit("success")), F.lit(0))
    problem = F.when(F.col("top_").isNull(), "unreadable")
    for key in REQUIRED:
        problem = problem.when(~F.map_contains_key("top_", F.lit(key)), f"missing {key}")
    problem = problem.when(spent > number("count"), "outcomes exceed count").when(F.col("st_").isNull(), "status_dict is no map").when(said != number("successes"), "status_dict disagrees")
    return out.withColumn("problem", problem).drop("top_", "st_")


def shard_problems(shards: DataFrame, members: DataFrame) -> DataFrame:
    """(shard, key, problem). shards: all expected ones with has_tar; members: shard, key, suffix, seq, payload.

    A missing or empty tar is its only problem. Bytes become hashes before anything is shuffled.
    """
    body = F.col("payload").cast("string")  # bytes that aren't UTF-8 are no JSON
    m = members.select("shard", "key", "suffix", "seq", F.when(F.col("suffix") == ".jpg", F.sha2("payload", 256)).alias("sha"), F.when(F.col("suffix") == ".json", F.try_parse_json(F.when(F.is_valid_utf8(body), body))).alias("meta"))
    image, side = F.col("suffix") == ".jpg", F.col("suffix") == ".json"
    good = side & F.col("meta").isNotNull()
    declared = F.try_variant_get("meta", "$.sha256", "string")
    keys = m.where(image | side).groupBy("shard", "key").agg(
        F.count_if(image).alias("images"), F.count_if(good).alias("sides"), F.count_if(side & F.col("meta").isNull()).alias("broken"),
        F.max_by("sha", F.when(image, F.col("seq"))).alias("sha"), F.max_by(declared, F.when(good, F.col("seq"))).alias("declared"),
    )
    per = keys.groupBy("shard").agg(F.sum("images").alias("all_images"))
    bare = shards.join(per, "shard", "left").select("shard", F.when(~F.col("has_tar"), "missing tar").when(F.coalesce("all_images", F.lit(0)) == 0, "empty shard").alias("problem"))
    whole = keys.join(bare.where("problem IS NULL").select("shard"), "shard")
    found = F.array(
        F.when((F.col("images") > 1) | (F.col("sides") > 1), "duplicate key"),
        F.when((F.col("images") > 0) & (F.col("sides") == 0), "missing sidecar"),
        F.when((F.col("images") > 0) & (F.col("sides") > 0) & (F.col("sha") != F.col("declared")), "sha256 mismatch"),
        F.when((F.col("images") == 0) & (F.col("sides") > 0), "metadata without image"),
        F.when(F.col("broken") > 0, "invalid json"),
    )
    each = whole.select("shard", "key", F.explode(F.array_compact(found)).alias("problem"))
    late = keys.where("broken > 0").join(bare.where("problem = 'empty shard'").select("shard"), "shard").select("shard", "key", F.lit("invalid json").alias("problem"))
    return bare.where("problem IS NOT NULL").select("shard", F.lit(None).cast("string").alias("key"), "problem").union(each).union(late)


def keepable(stats: DataFrame, min_yield: float = T.KEEPABLE_SHARD_YIELD) -> DataFrame:
    """Whether a finished shard survives a retry; unreadable or NULL statistics don't."""
    good = (F.col("count") > 0) & (F.try_divide(F.col("successes").cast("double"), F.col("count")) >= min_yield)
    return stats.withColumn("keep", F.coalesce(good, F.lit(False)))
