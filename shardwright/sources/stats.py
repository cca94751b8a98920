"""Statistics, plans and markers as frames (A8, A13, A15-A17). Files that can't be read stay visible as rows."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..operators import outcomes
from ..operators.partition import task_plan
from . import listing

PLAN = "meta_dir string, urls_per_task long, total_rows long, tasks array<struct<task_id: long, rows: long, pieces: array<struct<path: string, start: long, `end`: long>>>>"
MARKER = "task_id long, completed_at string, wall_seconds double, candidates long, planned_candidates long, partial boolean, successes long, yield double, settings struct<threads: long, retries: long, processes: long, timeout: double>, salvaged boolean"


def _texts(spark: SparkSession, paths: list[tuple[str, Path]]) -> DataFrame:
    """(task, path, raw): raw is NULL for an empty or missing file."""
    listed = spark.createDataFrame([(t, str(p.resolve())) for t, p in paths], "task string, path string")
    there = [str(p) for _, p in paths if p.is_file()]
    if not there:
        return listed.withColumn("raw", F.lit(None).cast("string"))
    read = spark.read.text(there, wholetext=True)
    read = read.select(F.url_decode(F.regexp_replace("_metadata.file_path", "^file:/+", "/")).alias("path"), F.col("value").alias("raw"))
    return listed.join(read, "path", "left").select("task", "path", "raw")


def read_stats(spark: SparkSession, root: str, set_aside: bool = False) -> DataFrame:
    """Per shard: task, shard, count, successes, status_dict (NULL where unreadable), raw. Numbers in any JSON spelling."""
    found = _texts(spark, [(t.name, p) for t in listing.task_dirs(root, set_aside) for p in listing.stats_files(t)])
    top = F.from_json("raw", "map<string,string>")
    number = lambda k: F.expr(f"cast(try_cast(top_['{k}'] AS double) AS bigint)").alias(k)
    return found.withColumn("top_", top).select(
        "task", F.regexp_extract("path", r"/(\d+)_stats\.json$", 1).alias("shard"), number("count"), number("successes"),
        F.from_json(F.col("top_")["status_dict"], "map<string,bigint>").alias("status_dict"), "raw",
    )


def measured_shards(spark: SparkSession, root: str, tasks: int = T.SAMPLE_TASKS, shards: int = T.SAMPLE_SHARDS) -> DataFrame:
    """(task, shard, bytes, successes): tars joined to the statistics of the same stem, of each of the first tasks the
    first shards; statistics without a tar, or that can't be read, are skipped (A18, J3, H8)."""
    said = read_stats(spark, root).where("successes IS NOT NULL").select("task", "shard", "successes")
    both = listing.tar_sizes(spark, root).join(said, ["task", "shard"])
    first = both.select("task").distinct().orderBy("task").limit(tasks)
    nth = F.row_number().over(Window.partitionBy("task").orderBy("shard"))
    return both.join(F.broadcast(first), "task").withColumn("nth_", nth).where(F.col("nth_") <= shards).select("task", "shard", "bytes", "successes")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """(task_id, rows, seq, path, start, end)."""
    plan = spark.read.schema(PLAN).json(path, multiLine=True).select(F.explode("tasks").alias("t"))
    return plan.select("t.task_id", "t.rows", F.posexplode("t.pieces").alias("seq", "p")).select("task_id", "rows", "seq", "p.path", "p.start", "p.end")


def plan_json(spark: SparkSession, cut: DataFrame, meta_dir: str, per_task: int) -> DataFrame:
    """The one-row plan for a JSON sink; paths are relative to meta_dir."""
    base = meta_dir.rstrip("/") + "/"
    rel = cut.withColumn("path", F.when(F.col("path").startswith(base), F.substring("path", len(base) + 1, 1 << 20)).otherwise(F.col("path")))
    return task_plan(rel).agg(F.sort_array(F.collect_list(F.struct("task_id", "rows", "pieces"))).alias("tasks"), F.sum("rows").alias("total_rows")).select(F.lit(meta_dir).alias("meta_dir"), F.lit(per_task).alias("urls_per_task"), "total_rows", "tasks")


def read_markers(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """(task_id, present, usable, candidates, successes, wall_seconds, settings) of the task directories in a range; markers
    that are absent or can't be read have NULLs (A15, J6)."""
    dirs = {t.name: t for t in listing.task_dirs(root)}
    wanted = [(f"task-{i:06d}", dirs[f"task-{i:06d}"] / "DONE.json") for i in range(first, last + 1) if f"task-{i:06d}" in dirs]
    body = F.from_json("raw", MARKER)
    return _texts(spark, wanted).withColumn("m", body).select(
        F.regexp_extract("task", r"-(\d+)$", 1).cast("long").alias("task_id"), F.col("raw").isNotNull().alias("present"), F.coalesce((F.col("m.candidates") > 0) & (F.col("m.wall_seconds") > 0), F.lit(False)).alias("usable"), "m.candidates", "m.successes", "m.wall_seconds", "m.settings"
    )


_SHARD = "count bigint, successes bigint, status_dict map<string,bigint>"


def _number(path: Path) -> float | None:
    """The number that a small file holds; None if there is none."""
    try:
        return float(path.read_text())
    except (OSError, ValueError):
        return None


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Statistics of run directories run<N>_p<P> (A16): run, processes, wall_seconds and the shards' columns."""
    folders = [r for r in sorted(Path(root).glob("run*_p*")) if re.fullmatch(r"run\d+_p\d+", r.name)]
    found = _texts(spark, [(r.name, p) for r in folders for p in sorted(r.rglob("*_stats.json"))])
    walls = spark.createDataFrame([(r.name, _number(r / "wall_seconds")) for r in folders], "task string, wall_seconds double")
    number = lambda k: F.regexp_extract("task", r"^run(\d+)_p(\d+)$", k).cast("long")
    return found.join(walls, "task").withColumn("t", F.from_json("raw", _SHARD)).select(number(1).alias("run"), number(2).alias("processes"), "wall_seconds", "t.*")


def read_phases(spark: SparkSession, root: str) -> DataFrame:
    """A row for each phase below root (<phase>/<node>/...): nodes that reported, expected_nodes, wall_seconds, the counters and
    rates over all nodes, and whether the phase ran on one node or more (A17, F14)."""
    phases = [p for p in sorted(Path(root).iterdir()) if p.is_dir()]
    said = [(p.name, n if (n := _number(p / "expected_nodes")) is None else int(n), _number(p / "wall_seconds")) for p in phases]
    phase = spark.createDataFrame(said, "phase string, expected_nodes long, wall_seconds double")
    base = str(Path(root).resolve())
    node = F.split(F.substring("path", len(base) + 2, 1 << 20), "/")[1]
    each = _texts(spark, [(p.name, s) for p in phases for s in sorted(p.rglob("*_stats.json"))]).withColumnRenamed("task", "phase")
    each = each.withColumn("t", F.from_json("raw", _SHARD)).select("phase", node.alias("node"), "t.*")
    nodes = each.groupBy("phase").agg(F.countDistinct("node").alias("nodes"))
    summary = outcomes.run_summary(each, outcomes.exploded(each, "phase"), "phase").join(nodes, "phase")
    return outcomes.with_rates(phase.join(summary, "phase", "left"), "wall_seconds")
