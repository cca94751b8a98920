"""Tasks from plan to DONE: skip what is complete, claim, keep good shards, fetch the rest, write, judge, mark."""

from __future__ import annotations

import os
import shutil
from contextlib import ExitStack
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..errors import EngineError
from ..functions.names import shard_of, task_of
from ..sources import listing, shards, sinks, stats
from . import ingest, outcomes, partition, planning, schema, verdicts

STORE = ".fetched"


@dataclass(frozen=True)
class Settings:
    """How a task is fetched; what is written into DONE.json."""

    threads: int = T.THREADS
    timeout: float = T.TIMEOUT_S
    retries: int = T.RETRIES
    per_shard: int = T.SAMPLES_PER_SHARD
    cap: int | None = None
    token: str | None = None
    owner: str = "run"
    #: Whether faces are blurred. Images are stored as they come, so 1 is refused.
    blur: int | None = 0

    def marker(self) -> dict:
        return {"threads": self.threads, "retries": self.retries, "processes": None, "timeout": self.timeout}


def planned_rows(spark: SparkSession, plan: DataFrame, metadata: str | None) -> DataFrame:
    """(task, place, url, caption) of a plan's pieces; paths are looked for below metadata if they aren't where the plan
    says. One read over all tasks; the files are those of the pieces, a few a task."""
    found = {r.path: str(Path(listing.rebased(r.path, metadata)).resolve()) for r in plan.select("path").distinct().collect()}
    columns = schema.resolve(listing.schema_names(next(iter(found.values()))) or []).bound
    if not columns["url"]:
        raise EngineError("no URL column")
    wanted = [c for c in (columns["url"], columns["caption"]) if c]
    rows = listing.with_positions(spark, sorted(set(found.values())), *wanted)
    where = spark.createDataFrame(list(found.items()), "path string, at string")
    cut = plan.join(F.broadcast(where), "path")  # a row for each file
    order = Window.partitionBy("task_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("before", F.coalesce(F.sum(F.col("end") - F.col("start")).over(order), F.lit(0)))
    pieces = cut.select(F.col("task_id").alias("task"), F.col("before").alias("seq"), F.col("at").alias("path"), "start", "end")
    caption = F.col(columns["caption"]) if columns["caption"] else F.lit(None)
    return partition.manifest_of(rows, pieces).select("task", "place", F.col(columns["url"]).alias("url"), caption.cast("string").alias("caption"))


def unfinished(spark: SparkSession, plan: DataFrame, root: str, first: int, last: int) -> DataFrame:
    """(task_id, rows) of the tasks in a range that aren't complete (L2)."""
    tasks = plan.where(F.col("task_id").between(first, last)).select("task_id", "rows").distinct()
    verdict = partition.completeness(tasks, stats.read_markers(spark, root, first, last))
    return tasks.join(verdict.where("verdict <> 'skip'").select("task_id"), "task_id")


def finished_shards(spark: SparkSession, tasks: list[Path]) -> DataFrame:
    """(task, shard) of the shards whose statistics are there, and with them the rest."""
    names = [(t.name, p.name) for t in tasks for p in listing.stats_files(t)]
    return spark.createDataFrame(names, "dir string, name string").select(task_of(F.col("dir")).alias("task"), shard_of(F.col("name")).alias("shard"))


def produce(spark: SparkSession, plan_file: str, root: str, first: int, last: int, metadata: str | None = None, settings: Settings = Settings()) -> list[dict]:
    """Runs the tasks first to last that aren't complete, as one Spark job; each one's verdict.

    The driver handles tasks (at most MAX_UNFINISHED), never their rows. A run that stops leaves its locks to go stale,
    its answers in the store, and no half shard; the next one fetches only what neither the store nor a shard holds.
    """
    plan = stats.read_plan(spark, plan_file)
    planning.check_wave(first, last, plan.agg(F.coalesce(F.max("task_id") + 1, F.lit(0))).first()[0], 0, settings.cap or T.MAX_UNFINISHED)
    planning.check_blur(settings.blur, False, False)
    if not 0 < settings.per_shard <= 10_000:
        raise EngineError("a shard's keys number 1 to 10000 samples")
    planning.check_root(root, plan_file)
    todo = {r.task_id: r.rows for r in unfinished(spark, plan, root, first, last).collect()}
    if not todo:
        return []
    tasks = {i: Path(root) / f"task-{i:06d}" for i in sorted(todo)}
    with ExitStack() as held:
        for task in tasks.values():
            task.mkdir(parents=True, exist_ok=True)
        locks = {i: held.enter_context(sinks.TaskLock(task, settings.owner)) for i, task in tasks.items()}
        for i, task in tasks.items():
            sinks.set_aside(spark, task, locks[i].path.name.rsplit(".", 1)[1])
        # answers of an earlier run are kept by position in the plan, whatever the shards' size
        rows = planned_rows(spark, plan.where(F.col("task_id").isin(list(tasks))), metadata)
        if settings.cap is not None:
            rows = rows.where(F.col("place") < settings.cap)
        rows = rows.withColumn("shard", F.expr(f"place div {settings.per_shard}"))
        left = rows.join(finished_shards(spark, list(tasks.values())), ["task", "shard"], "left_anti")
        left = left.withColumn("pos", F.col("task") * F.lit(1 << 32) + F.col("place"))
        store = os.path.join(root, STORE)
        ingest.fetch_into(left.select("pos", "url"), store, settings.threads, settings.timeout, settings.token, settings.retries)
        key = F.format_string("%05d%04d", "shard", F.expr(f"place % {settings.per_shard}"))
        got = ingest.stored(spark, store).drop("url")
        full = left.withColumn("key", key).join(got, "pos").select("task", "shard", "key", "url", "caption", "status", "error_message", "sha256", "payload")
        shards.write_shards(full, root, [lock.fence() for lock in locks.values()])
        shutil.rmtree(store, ignore_errors=True)
        return judged(spark, root, tasks, todo, locks, settings)


def judged(spark: SparkSession, root: str, tasks: dict[int, Path], planned: dict[int, int], locks: dict[int, sinks.TaskLock], settings: Settings) -> list[dict]:
    """health.json of each task; DONE.json of those that are healthy and still ours. No shard at all is a failure."""
    s = stats.read_stats(spark, root).where("count IS NOT NULL").join(F.broadcast(spark.createDataFrame([(t.name,) for t in tasks.values()], "task string")), "task")
    summary = outcomes.with_rates(outcomes.run_summary(s, outcomes.exploded(s, "task"), "task"))
    found = {r["task"]: r.asDict() for r in verdicts.health(summary).collect()}
    out = []
    for i, task in tasks.items():
        got = found.get(task.name, {"task": task.name, "healthy": False, "cause": "no_shards", "reason": "no shard was written", "candidates": 0, "successes": 0})
        sinks.write_json(got, str(task / "health.json"))
        done = bool(got["healthy"] and locks[i].mine())
        if done:
            sinks.write_marker(task, got, planned=planned[i], settings=settings.marker())
        out.append({"task_id": i, "done": done, **got})
    return out


def archived(root: str, experiment: str) -> Path | None:
    """Moves a former attempt of an experiment aside, to <experiment>.attempt-<n>, the next free number."""
    here = Path(root) / experiment
    if not here.exists():
        return None
    for n in range(1, 1 << 20):
        try:
            # mkdir is what one run of several can do; a directory is renamed over an empty one
            (there := here.with_name(f"{experiment}.attempt-{n}")).mkdir()
        except FileExistsError:
            continue
        here.rename(there)
        return there
    raise EngineError(f"too many attempts of {here}")
