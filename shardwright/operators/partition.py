"""Positions, slices and fixed-size tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import EngineError, ManifestError
from ..functions.names import path_order

#: Rows of a file that can meet in one key of a lookup.
STRIPE = 100_000


def offsets(sources: DataFrame) -> DataFrame:
    """(path, rows, off): rows before each file, in the order of path components. One row per file meets in one task."""
    return sources.withColumn("off", F.sum("rows").over(Window.orderBy(path_order(F.col("path"))).rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows"))


def pieces(sources: DataFrame, per_task: int, ordered: DataFrame | None = None) -> DataFrame:
    """(task, seq, path, start, end): greedy cut into tasks of per_task rows; the short last one stays."""
    if per_task <= 0:
        raise EngineError("a task has to hold at least one URL")
    o = (ordered or offsets(sources)).where("rows > 0")
    e = o.select("*", F.explode(F.expr(f"sequence(off div {per_task}, (off + rows - 1) div {per_task})")).alias("task"))
    start, end = F.greatest(F.col("off"), F.col("task") * per_task), F.least(F.col("off") + F.col("rows"), (F.col("task") + 1) * per_task)
    return e.select("task", (start - F.col("task") * per_task).alias("seq"), "path", (start - F.col("off")).alias("start"), (end - F.col("off")).alias("end"))


def task_plan(cut: DataFrame) -> DataFrame:
    """pieces() as one row per task: task_id, rows, pieces in order."""
    return cut.groupBy(F.col("task").alias("task_id")).agg(
        F.sum(F.col("end") - F.col("start")).cast("long").alias("rows"),
        F.transform(F.sort_array(F.collect_list(F.struct("seq", "path", "start", "end"))), lambda x: x.dropFields("seq")).alias("pieces"),
    )


def partition_summary(sources: DataFrame, per_task: int) -> DataFrame:
    got = sources.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total_rows"))
    left = F.col("total_rows") % per_task
    tasks = F.expr(f"(total_rows + {per_task - 1}) div {per_task}")
    last = F.when(F.col("total_rows") == 0, 0).when(left == 0, per_task).otherwise(left)
    return got.select("total_rows", tasks.alias("tasks"), F.expr(f"total_rows div {per_task}").alias("full_tasks"), last.cast("long").alias("last_rows"))


def positioned(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (path, row_index, ...) with pos, their place among the rows of all files (H10). sources has a row per file."""
    return rows.join(offsets(sources).select("path", "off"), "path").withColumn("pos", F.col("off") + F.col("row_index")).drop("off")


def manifest(rows: DataFrame, per_task: int) -> DataFrame:
    """Positioned rows with their task: one projection for all tasks."""
    return rows.withColumn("task", F.expr(f"pos div {int(per_task)}"))


def manifest_of(rows: DataFrame, cut: DataFrame, width: int = STRIPE) -> DataFrame:
    """Rows (path, row_index) inside a plan's pieces (J7): an equi-join on the path and a stripe of `width` rows, with the range
    as rest. A piece stands in each stripe that it reaches into; a key has at most `width` rows of one file."""
    stripes = F.sequence(F.expr(f"start div {int(width)}"), F.expr(f"(`end` - 1) div {int(width)}"))
    p = cut.where(F.col("end") > F.col("start")).select("task", "seq", F.col("path").alias("p_"), "start", "end", F.explode(stripes).alias("stripe_"))
    inside = (F.col("path") == F.col("p_")) & (F.expr(f"row_index div {int(width)}") == F.col("stripe_")) & (F.col("row_index") >= F.col("start")) & (F.col("row_index") < F.col("end"))
    return rows.join(p, inside).withColumn("place", F.col("seq") + F.col("row_index") - F.col("start")).drop("p_", "seq", "start", "end", "stripe_")


def concatenated(frames: list[DataFrame]) -> DataFrame:
    """Manifests one after another, as column `part` tells; refused unless all have the same columns and types."""
    if not frames:
        raise ManifestError("nothing to concatenate")
    want = frames[0].dtypes
    for k, f in enumerate(frames):
        if f.dtypes != want:
            raise ManifestError(f"part {k} has {f.dtypes}, the first one {want}")
    return reduce(DataFrame.union, [f.withColumn("part", F.lit(k)) for k, f in enumerate(frames)])


def piece(rows: DataFrame, total: int, start: int, end: int) -> DataFrame:
    """Rows [start, end) of a file of `total` rows; refused when out of bounds."""
    if not 0 <= start <= end <= total:
        raise ManifestError(f"rows {start} to {end} aren't within a file of {total}")
    return rows.where((F.col("row_index") >= start) & (F.col("row_index") < end))


def slices(rows: DataFrame, total: int, offset: int, count: int, k: int) -> DataFrame:
    """k disjoint slices of count rows from an offset on, as column `slice`; refused when rows are short."""
    if total - offset < count * k:
        raise EngineError(f"{total} rows hold {k} slices of {max(0, total - offset) // k} after {offset}, not of {count}")
    return rows.where((F.col("pos") >= offset) & (F.col("pos") < offset + count * k)).withColumn("slice", F.expr(f"(pos - {offset}) div {count}"))


def capped(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows by position."""
    return rows.where(F.col("pos") < n)


def file_prefix(sources: DataFrame, at_least: int) -> DataFrame:
    """The first files that hold at_least rows together (A4, A5)."""
    return offsets(sources).where(F.col("off") < at_least)


def completeness(plan: DataFrame, markers: DataFrame) -> DataFrame:
    """task_id, verdict: skip, `redo short G of W`, or `redo unverifiable`."""
    both = plan.select("task_id", F.col("rows").alias("want")).join(markers.select("task_id", "candidates"), "task_id", "left")
    short = F.concat(F.lit("redo short "), F.col("candidates").cast("string"), F.lit(" of "), F.col("want").cast("string"))
    return both.select("task_id", F.when(F.col("candidates").isNull() | F.col("want").isNull(), "redo unverifiable").when(F.col("candidates") < F.col("want"), short).otherwise("skip").alias("verdict"))
