"""What complete tasks hold, opened as a trainer would."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tar import decodes
from . import distributions, verdicts

_RECORDS = "key string, caption string, exif string, original_width long, original_height long"


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(task, key, caption, exif, w, h) of shard parquets in either layout; a column that a file lacks is NULL."""
    df = spark.read.schema(_RECORDS).parquet(*paths)
    task = F.regexp_extract(F.url_decode("_metadata.file_path"), r"/([^/]+)/(?:shards/)?[^/]+$", 1)
    return df.select(task.alias("task"), "key", "caption", "exif", F.col("original_width").alias("w"), F.col("original_height").alias("h"))


def decoded(samples: DataFrame, folder: str | None = None) -> DataFrame:
    """(task, key, caption, ok): each sample's picture opened where it is read; pictures don't travel on.

    With a folder that all executors share, Spark's image source decodes them: each picture becomes a file there, and is ok
    if the JVM's codecs (PNG, JPEG, GIF, BMP) give it a size. Without one, a Python codec if there is any, else the framing.
    """
    if folder:
        return _decoded_files(samples, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([decodes(b or b"") for b in batch.column("image").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("task"), batch.column("key"), batch.column("caption"), ok], names=["task", "key", "caption", "ok"])

    return samples.select("task", "key", "caption", "image").mapInArrow(run, "task string, key string, caption string, ok boolean")


def _decoded_files(samples: DataFrame, folder: str) -> DataFrame:
    """As decoded(). A picture's file is named by its digest, so tasks that run twice write the same."""
    spark = samples.sparkSession
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for body in batch.column("image").to_pylist():
                name = hashlib.sha256(body or b"").hexdigest()
                at = os.path.join(folder, name)
                if not os.path.exists(at):
                    with open(part := f"{folder}/.{uuid.uuid4().hex}", "wb") as f:
                        f.write(body or b"")
                    os.replace(part, at)
                names.append(name)
            yield pa.RecordBatch.from_arrays([batch.column("task"), batch.column("key"), batch.column("caption"), pa.array(names, pa.string())], names=["task", "key", "caption", "file"])

    placed = samples.select("task", "key", "caption", "image").mapInArrow(run, "task string, key string, caption string, file string").persist()
    if not placed.count():
        return placed.select("task", "key", "caption", F.lit(False).alias("ok"))
    image = spark.read.format("image").option("dropInvalid", False).load(folder).select(F.element_at(F.split("image.origin", "/"), -1).alias("file"), (F.col("image.height") > 0).alias("ok"))
    return placed.join(image, "file", "left").select("task", "key", "caption", F.coalesce("ok", F.lit(False)).alias("ok"))


def opened(samples: DataFrame, known: DataFrame, folder: str | None = None) -> DataFrame:
    """One row: decoded, decode_failures, caption_mismatches. Captions are compared by task and key, of pictures that open.

    Keys repeat across tasks; a (task, key) that was recorded more than once counts once.
    """
    seen = decoded(samples, folder)
    wrong = distributions.caption_mismatches(seen.where("ok").drop("ok"), known.select("task", "key", "caption"))
    wrong = wrong.select("task", "key").distinct().agg(F.count("*").alias("caption_mismatches"))
    counts = seen.agg(F.count_if("ok").alias("decoded"), F.count_if(~F.col("ok")).alias("decode_failures"))
    return counts.crossJoin(wrong)  # one row each


def report(samples: DataFrame, known: DataFrame, candidates: int, successes: int, folder: str | None = None) -> DataFrame:
    """One row: the counts, EXIF characters, and the pilot's verdict."""
    exif = known.agg(F.coalesce(F.sum(F.length("exif")), F.lit(0)).alias("exif_bytes"))
    both = opened(samples, known, folder).crossJoin(exif)  # one row each
    return verdicts.pilot_verdict(both.withColumns({"candidates": F.lit(candidates).cast("long"), "successes": F.lit(successes).cast("long")}))
