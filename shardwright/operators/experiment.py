"""Experiments: a corpus is sliced once for all levels, each level fetches its own slice, and the runs are judged."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError
from ..sources import listing, shards, stats
from . import ingest, outcomes, partition, planning, production, schema, verdicts


@dataclass(frozen=True)
class Design:
    """Levels are numbers of processes, in the order of their runs; each gets a slice of its own."""

    levels: tuple[int, ...]
    urls: int
    per_shard: int
    offset: int = 0


def problems(spark: SparkSession, source: str, design: Design) -> list[str]:
    """Why an experiment shouldn't be submitted: levels without enough shards, a source without URLs, too few rows."""
    levels = spark.createDataFrame([(n,) for n in design.levels], "requested long")
    plan = planning.level_plan(levels, design.urls, design.per_shard)
    found = [f"level {r.requested}: {r.problem}" for r in planning.level_problems(plan).orderBy("requested").collect()]
    told = listing.describe(spark, source)
    if told["error"]:
        found.append(str(told["error"]))
    if told["rows"] < (want := design.offset + design.urls * len(design.levels)):
        found.append(f"{told['rows']} rows are fewer than the {want} that are sliced")
    return found


def sliced(spark: SparkSession, source: str, design: Design) -> DataFrame:
    """(slice, pos, url), pos from 0 in each slice; no URL is in two slices."""
    counts = listing.row_counts(spark, source).where("rows IS NOT NULL")
    files = [str(p.resolve()) for p in listing.parquet_files(source)]
    column = schema.slicing_column(listing.describe(spark, source)["columns"])
    placed = partition.positioned(listing.with_positions(spark, files, column), counts)
    total = counts.agg(F.sum("rows")).first()[0] or 0
    cut = partition.slices(placed, total, design.offset, design.urls, len(design.levels))
    return cut.select("slice", (F.col("pos") - design.offset - F.col("slice") * design.urls).alias("pos"), F.col(f"`{column}`").alias("url"))


def run(spark: SparkSession, source: str, root: str, design: Design, settings: production.Settings = production.Settings()) -> Path | None:
    """Runs all levels, one after another, into <root>/run<N>_p<level>; returns where a former attempt went.

    All is checked before anything is written. A level that writes no shard stops the experiment (L6).
    """
    if found := problems(spark, source, design):
        raise EngineError("; ".join(found))
    former = production.archived(str(Path(root).parent), Path(root).name)
    rows = sliced(spark, source, design)
    rows.select("slice", "pos", "url").write.partitionBy("slice").parquet(f"{root}/slices")
    for k, level in enumerate(design.levels):
        one = spark.read.parquet(f"{root}/slices/slice={k}")
        level_run(spark, one, Path(root) / f"run{k + 1}_p{level}", level, replace(settings, per_shard=design.per_shard))
    return former


def level_run(spark: SparkSession, rows: DataFrame, folder: Path, processes: int, settings: production.Settings) -> None:
    """Fetches rows (pos, url) with so many tasks at a time; shards, and the seconds of wall time beside them."""
    began = time.monotonic()
    store = str(folder / production.STORE)
    ingest.fetch_into(rows, store, settings.threads, settings.timeout, settings.token, settings.retries, processes=processes)
    shard = F.expr(f"pos div {settings.per_shard}")
    full = rows.join(ingest.stored(spark, store).drop("url"), "pos").select(F.lit(0).cast("long").alias("task"), shard.alias("shard"), F.format_string("%05d%04d", shard, F.expr(f"pos % {settings.per_shard}")).alias("key"), "url", "status", "error_message", "sha256", "payload")
    shards.write_shards(full, str(folder))
    if not next(folder.rglob("*_stats.json"), None):
        raise EngineError(f"{folder} has no shard")
    (folder / "wall_seconds").write_text(f"{time.monotonic() - began:.3f}")


def compared(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Runs of an experiment on processes, in their order, and the one-row verdict over them."""
    found = stats.read_runs(spark, root)
    runs = _rated(found, "run", "processes")
    return runs, verdicts.concurrency_verdict(runs)


def distributed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Phases whose nodes all reported, and the one-row verdict over them (A17, V3). A phase's wall time is the slowest node's."""
    phases = verdicts.complete_phases(stats.read_phases(spark, root))
    return phases, verdicts.distribution_verdict(phases, "phase")


def _rated(shards_: DataFrame, *keys: str) -> DataFrame:
    """Summaries with rates; the wall time is one figure a run, whatever the number of its shards."""
    walls = shards_.groupBy(*keys).agg(F.max("wall_seconds").alias("wall_seconds"))
    summary = outcomes.run_summary(shards_, outcomes.exploded(shards_, *keys), *keys).join(walls, list(keys))
    return outcomes.with_rates(summary, "wall_seconds")
