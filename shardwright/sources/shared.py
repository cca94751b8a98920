"""Folders that all executors see, for trees that one job writes and another one reads."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from ..errors import EngineError


def shared_folder(spark: SparkSession) -> str:
    """Where spark.checkpoint.dir points. On a local master without that setting, a temporary folder is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and spark.sparkContext.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise EngineError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shardwright-"))
    found = re.sub("^file:/+", "/", named or spark.sparkContext.getCheckpointDir())
    if "://" in found:
        raise EngineError(f"{found} can't be reached by path, as tars and locks need")
    return found.rstrip("/")


def new_tree(spark: SparkSession, name: str) -> Path:
    """A new path in the shared folder; what is written there goes with the process."""
    path = Path(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
