"""Commands: inspect, plan, produce, resolution, hosts, assess, slow, report, verify, arms, remaining, salvage, cap, slices, size,
check, run, runs, phases, bench.

Exit codes: 0 all well, 1 rejected or a finding, 2 wrong usage or nothing to do.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import thresholds as T
from .errors import EngineError
from .operators import distributions, experiment, outcomes, partition, pilot, planning, production, schema, verdicts
from .sources import listing, sinks, stats, tar


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.appName("shardwright").getOrCreate()


def _out(report: dict, path: str | None) -> None:
    text = json.dumps(report, indent=2, default=str)
    print(text)
    if path:
        sinks.write_json(json.loads(text), path)


def _task_summary(spark: SparkSession, root: str):  # noqa: ANN202
    s = stats.read_stats(spark, root).where("count IS NOT NULL")
    return outcomes.with_rates(outcomes.run_summary(s, outcomes.exploded(s, "task"), "task"))


def inspect(spark: SparkSession, a: argparse.Namespace) -> int:
    if not listing.is_parquet(a.source):
        _out({"format": "text"}, a.json)
        return 0
    found = listing.describe(spark, a.source)
    names = listing.schemas(spark, a.source)
    _out({"format": "parquet", **found, "mismatched": schema.mismatches(names)}, a.json)
    return 0 if found["url_column"] else 2


def plan(spark: SparkSession, a: argparse.Namespace) -> int:
    sources = listing.row_counts(spark, a.source)
    bad = [r.path for r in sources.where("rows IS NULL").collect()]
    if bad:
        print("unreadable: " + ", ".join(bad), file=sys.stderr)
    sources = sources.where("rows IS NOT NULL")
    summary = partition.partition_summary(sources, a.per_task)
    report = summary.first().asDict()
    if not report["total_rows"]:
        return 2
    if a.json:
        cut = stats.plan_json(spark, partition.pieces(sources, a.per_task), str(Path(a.source).resolve()), a.per_task)
        sinks.write_json(cut, a.json)
    _out(report | {"projection": [r.asDict() for r in planning.scale_projection(summary).collect()]}, None)
    return 0


def produce(spark: SparkSession, a: argparse.Namespace) -> int:
    """Fetches the tasks of a range that aren't complete; 1 if one of them isn't healthy."""
    first, _, last = a.tasks.partition("-")
    settings = production.Settings(a.threads, a.timeout, a.retries, a.per_shard, a.cap, a.token)
    got = production.produce(spark, a.plan, a.source, int(first), int(last or first), a.metadata, settings)
    _out({"tasks": got}, a.json)
    return int(not all(t["done"] for t in got))


def resolution(spark: SparkSession, a: argparse.Namespace) -> int:
    files = [str(p) for p in listing.parquet_files(a.source)]
    picked = [files[i] for i in distributions.even_sample(len(files), a.files)]
    if not picked:
        return 2
    roles = schema.resolve(listing.schema_names(picked[0]) or [])
    if not (roles.bound["width"] and roles.bound["height"]):
        print("no size is recorded", file=sys.stderr)
        return 2
    sizes = spark.read.parquet(*picked).select(F.col(roles.bound["width"]).cast("long").alias("w"), F.col(roles.bound["height"]).cast("long").alias("h"))
    counts = distributions.side_counts(sizes)
    ladders = {"percentiles": [r.asDict() for r in distributions.percentiles(distributions.sides(sizes), "short_side").collect()], "below": [r.asDict() for r in distributions.below(counts).collect()]}
    _out(ladders | {"files": len(picked), "degenerate": distributions.degenerate(counts).first().asDict(), **distributions.unusable_count(sizes).first().asDict()}, a.json)
    return 0


def hosts(spark: SparkSession, a: argparse.Namespace) -> int:
    """Connections that the first URLs of a source need, read from no more files than hold them."""
    counts = listing.row_counts(spark, a.source).where("rows IS NOT NULL")
    picked = partition.file_prefix(counts, a.limit).cache()  # a row for each file
    files = [r.path for r in picked.orderBy("off").limit(a.files).collect()]
    column = schema.resolve(listing.schema_names(files[0]) or []).bound["url"] if files else None
    if column is None:
        print("no URLs", file=sys.stderr)
        return 2
    placed = partition.positioned(listing.with_positions(spark, files, column), counts)
    urls = partition.capped(placed, a.limit).select("pos", F.col(column).alias("url"))
    got = distributions.host_concentration(urls, a.window).first().asDict()
    _out(got | {"top_hosts": [r.asDict() for r in distributions.top_hosts(urls, 10).collect()]}, a.json)
    return 0 if got["urls"] else 2


def assess(spark: SparkSession, a: argparse.Namespace) -> int:
    task = Path(a.source)
    got = verdicts.health(_task_summary(spark, str(task.parent)).where(F.col("task") == task.name)).first()
    if got is None:
        print(f"{task} has no statistics", file=sys.stderr)
        return 2
    _out(got.asDict(), a.json or str(task / "health.json"))
    return 0 if got["healthy"] else 1


def salvage(spark: SparkSession, a: argparse.Namespace) -> int:
    task = Path(a.source)
    got = verdicts.health(_task_summary(spark, str(task.parent)).where(F.col("task") == task.name)).first()
    if got is None:
        return 2
    try:
        sinks.write_marker(task, got.asDict(), salvaged=True)
    except EngineError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


def slow(spark: SparkSession, a: argparse.Namespace) -> int:
    s = stats.read_stats(spark, a.source).where("count IS NOT NULL").withColumn("all", F.lit("all"))
    summary = outcomes.with_rates(outcomes.run_summary(s, outcomes.exploded(s, "all"), "all"))
    diagnosis = verdicts.throughput_diagnosis(summary, a.node_hours * 3600, a.workers, a.timeout, a.retries)
    got = diagnosis.first()
    if got is None or not got["candidates"]:
        return 2
    options = verdicts.alternatives(diagnosis, a.timeout, a.retries, workers=a.workers).select("timeout", "retries", "gain", "urls_per_second", "task_hours")
    _out(got.asDict() | {"alternatives": [r.asDict() for r in options.collect()]}, a.json)
    return 0


def report(spark: SparkSession, a: argparse.Namespace) -> int:
    tasks = listing.task_dirs(a.source)
    done = [t for t in tasks if (t / "DONE.json").exists()]
    tars = {t.name: [str(p) for p in listing.tar_files(t)] for t in done}
    bare = [name for name, found in tars.items() if not found]
    if bare:
        print(f"marked as done without a tar: {', '.join(bare)}", file=sys.stderr)
        return 1
    if not done:
        print("no task is done yet", file=sys.stderr)
        return 1
    first, last = (int(t.name.rsplit("-", 1)[1]) for t in (done[0], done[-1]))
    marks = stats.read_markers(spark, a.source, first, last).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("candidates", "successes"))).first()
    parquets = [str(p) for t in done for p in listing.shard_parquets(t)]
    each = max(1, a.samples // len(done))
    samples = tar.read_samples(spark, [p for found in tars.values() for p in found[:2]], first=each)
    known = pilot.records(spark, parquets) if parquets else spark.createDataFrame([], "task string, key string, caption string, exif string, w long, h long")
    candidates, successes = marks["candidates"], marks["successes"]
    got = pilot.report(samples, known, candidates, successes, a.decode_in).first().asDict()
    sides = distributions.percentiles(distributions.sides(known), "short_side")
    size = sum(Path(p).stat().st_size for found in tars.values() for p in found)
    got |= {"tasks": len(done), "incomplete": len(tasks) - len(done), "tar_bytes": size, "parquet_bytes": sum(Path(p).stat().st_size for p in parquets)}
    got |= {"percentiles": [r.asDict() for r in sides.collect()], "corpus_tib": planning.pilot_projection(size, candidates) if candidates else None}
    _out(got, a.json)
    return int(got["stop"])


def verify(spark: SparkSession, a: argparse.Namespace) -> int:
    files = [str(p) for p in listing.parquet_files(a.source) if p.name != listing.MANIFEST and not any(x.startswith("attempt-") for x in p.parts)]
    picked = [files[i] for i in distributions.even_sample(len(files), a.files)]
    if not picked:
        return 2
    bare = sum("status" not in (listing.schema_names(p) or ()) for p in picked)  # the sampled files only
    df = spark.read.option("mergeSchema", True).parquet(*picked)
    status = F.col("status") if "status" in df.columns else F.lit(None).cast("string")
    rows = df.select(status.alias("status"), F.col("width").alias("w"), F.col("height").alias("h"), F.col("original_width").alias("ow"), F.col("original_height").alias("oh"))
    got = distributions.arrived(rows).first().asDict()
    drift = None
    if a.claimed:
        claimed = spark.createDataFrame([(r["p"], r["short_side"]) for r in json.loads(Path(a.claimed).read_text())["percentiles"]], "p long, short_side double")
        came = rows.where("(status IS NULL OR status = 'success') AND ow <> 0 AND oh <> 0").select(F.col("ow").alias("w"), F.col("oh").alias("h"))
        half = distributions.median_drift(claimed, distributions.percentiles(distributions.sides(came), "short_side")).where("p = 50").first()
        drift = half and half["drift"]
    _out(got | {"median_drift": drift, "files": len(picked), "files_without_status": bare}, a.json)
    return int(got["resized"] > 0 or (drift or 0) > T.ARRIVED_MEDIAN_DRIFT)


def arms(spark: SparkSession, a: argparse.Namespace) -> int:
    first, _, last = a.tasks.partition("-")
    marks = stats.read_markers(spark, a.source, int(first), int(last or first)).cache()
    unusable = [r.task_id for r in marks.where("NOT usable").orderBy("task_id").collect()]
    rows = marks.where("usable").select(F.col("task_id").alias("task"), "settings.threads", "settings.retries", "candidates", "successes", "wall_seconds")
    got = verdicts.chosen_arm(rows).first().asDict()
    days = {r.nodes: r.days for r in verdicts.arm_days(verdicts.chosen_arm(rows)).collect()}
    _out(got | {"days": days, "arms": [r.asDict() for r in verdicts.ranked_arms(rows).collect()] if got["n_arms"] else [], "missing": unusable}, a.json)
    return int(got["verdict"] == "too_few")


def remaining(spark: SparkSession, a: argparse.Namespace) -> int:
    tasks = stats.read_plan(spark, a.plan).select("task_id", "rows").distinct()
    last = tasks.agg(F.max("task_id")).first()[0]
    if last is None:
        return 2
    marks = stats.read_markers(spark, a.source, 0, last)
    got = partition.completeness(tasks, marks).where("verdict <> 'skip'").orderBy("task_id").collect()
    _out({"remaining": [r.asDict() for r in got]}, a.json)
    return int(bool(got))


def cap(spark: SparkSession, a: argparse.Namespace) -> int:
    sinks.cap_file(spark, a.source, a.rows)
    return 0


def slices(spark: SparkSession, a: argparse.Namespace) -> int:
    files = [str(p.resolve()) for p in listing.parquet_files(a.source)]
    column = schema.slicing_column(listing.schema_names(files[0]) or [])
    counts = listing.row_counts(spark, a.source).where("rows IS NOT NULL")
    placed = partition.positioned(listing.with_positions(spark, files, column), counts)
    cut = partition.slices(placed, counts.agg(F.sum("rows")).first()[0] or 0, a.offset, a.rows, a.slices)
    sinks.write_slices(cut.select("slice", "pos", column), a.to, column, a.text, "pos")
    return 0


def _design(a: argparse.Namespace) -> experiment.Design:
    return experiment.Design(tuple(int(n) for n in a.levels.split(",")), a.urls, a.per_shard, a.offset)


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    """What speaks against an experiment on a source; 1 if anything does."""
    found = experiment.problems(spark, a.source, _design(a))
    _out({"problems": found}, a.json)
    return int(bool(found))


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """Runs an experiment's levels on slices of a source."""
    former = experiment.run(spark, a.source, a.to, _design(a), production.Settings(a.threads, a.timeout, a.retries))
    _out({"former": former}, a.json)
    return runs(spark, argparse.Namespace(source=a.to, json=a.json))


def _judged(rows: DataFrame, order: str, verdict: DataFrame, path: str | None) -> int:
    got = [r.asDict() for r in rows.orderBy(order).collect()]
    if not got:
        print("nothing to compare", file=sys.stderr)
        return 2
    said = verdict.first().asDict()
    _out({"runs": got, **said}, path)
    return int(said["rejected"])


def runs(spark: SparkSession, a: argparse.Namespace) -> int:
    """Whether more processes gave more successes without costing yield."""
    rows, verdict = experiment.compared(spark, a.source)
    return _judged(rows, "run", verdict, a.json)


def phases(spark: SparkSession, a: argparse.Namespace) -> int:
    """Whether several nodes did as well as one; phases that a node is missing from don't count."""
    rows, verdict = experiment.distributed(spark, a.source)
    return _judged(rows, "phase", verdict, a.json)


def size(spark: SparkSession, a: argparse.Namespace) -> int:
    """Bytes an image of real shards, by task, and whether tasks or shards differ more."""
    shards = stats.measured_shards(spark, a.source, a.tasks, a.shards).cache()
    tasks = distributions.task_sizes(shards)
    rows = [r.asDict() for r in tasks.orderBy("task").collect()]
    if not rows:
        print("no shard with statistics and a tar", file=sys.stderr)
        return 2
    total = {c: sum(r[c] for r in rows) for c in ("bytes", "images")}
    per_image = total["bytes"] / total["images"]
    _out({"tasks": rows, **total, "bytes_per_image": per_image, "corpus_terabytes": planning.storage_projection(per_image), **distributions.size_report(tasks).first().asDict()} | {"tasks": rows}, a.json)
    return 0


def bench(spark: SparkSession, a: argparse.Namespace) -> int:
    got = tar.bench_total(tar.bench(spark, a.source)).first().asDict()
    _out(got, a.json)
    return 0 if got["attempted"] else 2


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shardwright", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for f in (inspect, plan, produce, resolution, hosts, assess, salvage, slow, report, verify, arms, remaining, cap, slices, size, check, run, runs, phases, bench):
        c = commands.add_parser(f.__name__)
        c.set_defaults(run=f)
        c.add_argument("source")
        c.add_argument("--json")
        for name, kind, value in {
            "plan": [("--per-task", int, T.URLS_PER_TASK)], "resolution": [("--files", int, T.SAMPLE_FILES)], "verify": [("--files", int, T.SAMPLE_FILES), ("--claimed", str, None)],
            "hosts": [("--files", int, T.HOST_FILES), ("--limit", int, T.HOST_URLS), ("--window", int, T.HOST_WINDOW)], "report": [("--samples", int, T.SAMPLE_IMAGES), ("--decode-in", str, None)],
            "slow": [("--node-hours", float, 1.0), ("--workers", int, T.PROCESSES * T.THREADS), ("--timeout", float, T.TIMEOUT_S), ("--retries", int, 2)], "arms": [("--tasks", str, "8-11")],
            "produce": [("--plan", str, "plan.json"), ("--tasks", str, "0"), ("--metadata", str, None), ("--threads", int, T.THREADS), ("--timeout", float, T.TIMEOUT_S), ("--retries", int, T.RETRIES), ("--per-shard", int, T.SAMPLES_PER_SHARD), ("--cap", int, None), ("--token", str, None)],
            **{f: [("--levels", str, "8,32,64,8"), ("--urls", int, 200_000), ("--per-shard", int, 1000), ("--offset", int, 0), ("--to", str, "experiment"), ("--threads", int, T.THREADS), ("--timeout", float, T.TIMEOUT_S), ("--retries", int, T.RETRIES)] for f in ("check", "run")},
            "size": [("--tasks", int, T.SAMPLE_TASKS), ("--shards", int, T.SAMPLE_SHARDS)], "remaining": [("--plan", str, "plan.json")], "cap": [("--rows", int, 1)], "slices": [("--rows", int, 1), ("--offset", int, 0), ("--slices", int, 1), ("--to", str, "slices"), ("--text", bool, False)],
        }.get(f.__name__, []):
            c.add_argument(name, type=kind, default=value)
    a = parser.parse_args(args)
    try:
        return a.run(spark or _session(), a)
    except EngineError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
