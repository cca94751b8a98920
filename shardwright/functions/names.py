"""File and directory names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_file(index: Column, suffix: str) -> Column:
    """00007.tar and the like; suffix .tar, .parquet or _stats.json. A negative index is refused."""
    name = F.format_string(f"%05d{suffix}", index)
    return F.when(index < 0, F.raise_error(F.lit("a shard's index can't be negative"))).otherwise(name)


def task_directory(task: Column) -> Column:
    return F.format_string("task-%06d", task)


def task_of(name: Column) -> Column:
    """The number after the last dash of a task directory's name."""
    return F.regexp_extract(name, r"-(\d+)$", 1).try_cast("long")


def shard_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\d+)", 1).try_cast("long")


def path_order(path: Column) -> Column:
    """Sorts as paths do, component by component."""
    return F.split(path, "/")
