"""Listings and footers (A1-A5, A7, A9, A12, A14, A18-A23, C6). Paths are the driver's; footers are read in tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError
from ..functions.names import path_order
from ..operators.schema import slicing_column

MANIFEST = "urls.parquet"


def _parts(p: Path) -> tuple[str, ...]:
    return p.parts


def parquet_files(source: str | os.PathLike) -> list[Path]:
    """A file itself, or all parquet files below a directory, sorted by path components."""
    root = Path(source)
    if not root.exists():
        raise EngineError(f"{root} doesn't exist")
    return [root] if root.is_file() else sorted(root.rglob("*.parquet"), key=_parts)


def is_parquet(source: str | os.PathLike) -> bool:
    root = Path(source)
    if root.is_dir():
        return any(root.rglob("*.parquet"))
    with root.open("rb") as f:
        return f.read(4) == b"PAR1"


def footers(spark: SparkSession, source: str | os.PathLike) -> DataFrame:
    """(path, rows, names) of every file in one pass over the footers, in tasks; NULLs where a file can't be read."""
    files = [str(p.resolve()) for p in parquet_files(source)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            rows, names = zip(*map(footer, paths))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(rows, pa.int64()), pa.array(names, pa.list_(pa.string()))], names=["path", "rows", "names"])

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)), "path")
    return listed.mapInArrow(run, "path string, rows long, names array<string>")


def footer(path: str | os.PathLike) -> tuple[int | None, list[str] | None]:
    """Rows and column names; (None, None) if the file can't be read."""
    try:
        with pq.ParquetFile(path) as f:
            return f.metadata.num_rows, f.schema_arrow.names
    except Exception:  # noqa: BLE001  any damage counts as unreadable
        return None, None


def row_counts(spark: SparkSession, source: str | os.PathLike) -> DataFrame:
    """(path, rows) of every file, empty ones too; unreadable files have NULL rows."""
    return footers(spark, source).select("path", "rows")


def schema_names(path: str | os.PathLike) -> list[str] | None:
    """Column names of one footer; None if it can't be read."""
    return footer(path)[1]


def schemas(spark: SparkSession, source: str | os.PathLike) -> list[tuple[str, list[str]]]:
    """(path, names) of the files that can be read, in the order of their paths."""
    found = footers(spark, source).where("names IS NOT NULL").select("path", "names").collect()
    return sorted(((r.path, r.names) for r in found), key=lambda x: _parts(Path(x[0])))


def describe(spark: SparkSession, source: str | os.PathLike) -> dict[str, object]:
    """Files, rows, first readable file's columns, and the URL column or why there is none."""
    got = footers(spark, source).agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min_by("names", F.when(F.col("names").isNotNull(), path_order(F.col("path")))).alias("columns")).first().asDict()
    got["columns"] = got["columns"] or []
    try:
        return got | {"url_column": slicing_column(got["columns"]), "error": None}
    except ValueError as e:
        return got | {"url_column": None, "error": str(e)}


def with_positions(spark: SparkSession, paths: list[str], *columns: str) -> DataFrame:
    """Columns of files with path and row_index, for positions."""
    df = spark.read.parquet(*paths)
    path = F.url_decode(F.regexp_replace("_metadata.file_path", "^file:/+", "/")).alias("path")
    return df.select(path, F.col("_metadata.row_index").alias("row_index"), *(f"`{c}`" for c in columns))


def metadata_sample(spark: SparkSession, source: str | os.PathLike, k: int) -> DataFrame:
    """The first k rows of the first file."""
    df = spark.read.parquet(str(parquet_files(source)[0]))
    return df.where(F.col("_metadata.row_index") < k)


def shard_dir(task: Path) -> Path:
    """`shards/` if it holds anything, else the task's own directory."""
    nested = task / "shards"
    return nested if nested.is_dir() and any(nested.iterdir()) else task


def task_dirs(root: str | os.PathLike, set_aside: bool = False) -> list[Path]:
    """Directories named task-*, sorted; those that were set aside (task-NNNNNN.attempt-*) only if asked for."""
    return sorted(p for p in Path(root).glob("task-*") if p.is_dir() and (set_aside or ".attempt-" not in p.name))


def stats_files(task: Path) -> list[Path]:
    return sorted(shard_dir(task).glob("*_stats.json"))


def tar_files(task: Path) -> list[Path]:
    return sorted(shard_dir(task).glob("*.tar"))


def shard_parquets(task: Path) -> list[Path]:
    return sorted(p for p in shard_dir(task).glob("*.parquet") if p.name != MANIFEST)


def find_shards(target: str | os.PathLike, limit: int | None = None) -> list[Path]:
    p = Path(target)
    return [p] if p.is_file() else sorted(p.glob("*.tar"))[:limit]


def rebased(recorded: str, root: str | None) -> str:
    """Where a plan's path is now: under root if relative; itself; or its longest tail that exists under root."""
    if not os.path.isabs(recorded):
        if root and os.path.exists(found := os.path.join(root, recorded)):
            return found
    elif os.path.exists(recorded):
        return recorded
    elif root:
        parts = Path(recorded).parts[1:]
        for cut in range(len(parts)):
            if (found := Path(root, *parts[cut:])).exists():
                return str(found)
    raise EngineError(f"{recorded} isn't there" + (f", nor below {root}" if root else ", and no metadata root is set"))


def tar_sizes(spark: SparkSession, root: str | os.PathLike) -> DataFrame:
    """(task, shard, bytes) of the tars of a tree, nested or flat, from file metadata; Spark lists the folders in parallel and
    opens no file. What was set aside is left out (A18)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True).load(str(root)).select("path", F.col("length").alias("bytes"))
    part = lambda k: F.regexp_extract("path", r"/(task-\d+)(?:/shards)?/(\d+)\.tar$", k)
    return found.select(part(1).alias("task"), part(2).alias("shard"), "bytes").where("task <> ''")


def hosts_of(spark: SparkSession, text: str) -> DataFrame:
    """(host) in order of first sight."""
    lines = spark.createDataFrame([(text,)], "t string").select(F.posexplode(F.split("t", r"\r?\n")))
    return lines.select(F.trim("col").alias("host"), "pos").where("host <> ''").groupBy("host").agg(F.min("pos").alias("pos")).orderBy("pos").select("host")
