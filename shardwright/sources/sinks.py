"""Sinks (B1-B9). Each writes beside the target and renames, so a reader never sees half a file."""

from __future__ import annotations

import json
import os
import shutil
import threading
import time
import uuid
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import thresholds as T
from ..errors import EngineError
from ..functions.names import shard_of
from ..operators.contract import keepable
from .listing import stats_files


def write_one(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One parquet file under a final name (B1)."""
    part = f"{path}.partial"
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").parquet(part)
    os.replace(next(Path(part).glob("part-*.parquet")), path)
    shutil.rmtree(part)


def cap_file(spark, path: str, n: int) -> bool:  # noqa: ANN001
    """Cuts a file to its first n rows, in place; False if it had no more (B2)."""
    df = spark.read.parquet(path)
    if df.count() <= n:
        return False
    write_one(df.where(F.col("_metadata.row_index") < n), path)
    return True


def write_slices(rows: DataFrame, folder: str, url_column: str | None = None, text: bool = False, order: str | None = None) -> None:
    """Sliced rows as slice=K folders, with the URL column's name beside them.

    With `order`, a slice's rows are in its order within its files and from file to file by their names.
    """
    if order:
        rows = rows.repartitionByRange("slice", order).sortWithinPartitions("slice", order)
    if text:
        rows.select("slice", F.col(url_column).alias("value")).write.partitionBy("slice").text(folder)
    else:
        rows.write.partitionBy("slice").parquet(folder)
    if url_column:
        Path(folder, "url_column").write_text(url_column)


def write_json(report: DataFrame | dict, path: str) -> None:
    """A one-row report as one JSON object; unknown stays null."""
    body = json.dumps(report, indent=2) if isinstance(report, dict) else report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0]
    part = Path(f"{path}.partial")
    part.parent.mkdir(parents=True, exist_ok=True)
    part.write_text(body)
    os.replace(part, path)


def write_marker(task: Path, health: dict, fetch_code: int = 0, planned: int | None = None, wall: float | None = None, settings: dict | None = None, salvaged: bool = False) -> None:
    """DONE.json of a healthy task whose fetch ended well; anything else is refused."""
    if not health.get("healthy") or fetch_code:
        raise EngineError(f"{task.name} isn't complete: {health.get('reason') or f'the fetch ended with {fetch_code}'}")
    body = {"task_id": int(task.name.rsplit("-", 1)[1]), "completed_at": datetime.now(UTC).isoformat(timespec="seconds"), "wall_seconds": wall, "candidates": health["candidates"], "planned_candidates": planned, "partial": planned is not None and health["candidates"] < planned, "successes": health["successes"], "yield": health["yield_rate"], "settings": settings or {}}
    write_json(body | ({"salvaged": True} if salvaged else {}), str(task / "DONE.json"))


def set_aside(spark, task: Path, tag: str, min_yield: float = T.KEEPABLE_SHARD_YIELD) -> tuple[int, int]:  # noqa: ANN001
    """Moves every file of a finished shard that isn't keepable to attempt-<tag>/; (kept, moved)."""
    from .stats import _texts

    files = stats_files(task)
    if not files or files[0].parent.name != "shards":
        return 0, 0
    top = F.from_json("raw", "map<string,string>")
    got = _texts(spark, [(task.name, p) for p in files]).withColumn("t", top)
    number = lambda k: F.expr(f"cast(try_cast(t['{k}'] AS double) AS bigint)").alias(k)
    name = F.element_at(F.split("path", "/"), -1)
    rows = keepable(got.select(shard_of(name).alias("shard"), F.regexp_extract(name, r"^(\d+)", 1).alias("stem"), number("count"), number("successes")), min_yield).collect()
    bad = [r.stem for r in rows if not r.keep]
    if bad:
        aside = task / f"attempt-{tag}"
        aside.mkdir(exist_ok=True)
        for stem in bad:
            for p in [*(task / "shards").glob(f"{stem}.*"), *(task / "shards").glob(f"{stem}_*")]:
                p.rename(aside / p.name)
    return len(rows) - len(bad), len(bad)


class TaskLock:
    """A task's lock with generations (L1): directories RUNNING.lock.<n>, of which the highest holds.

    A run claims the number after the highest it saw, which only one run can make, and only if that one's last beat is
    stale (`stale` seconds; the owner's file is touched every `every`). Who made a directory but finds a higher one, or
    finds its own replaced, doesn't hold the lock: mine() says so, and a holder asks before each commit. Numbers begin at
    the time in nanoseconds, so a run that comes late with an old number stays below the holder's.
    """

    NAME = "RUNNING.lock"

    def __init__(self, task: Path, owner: str, stale: float = T.LOCK_STALE_S, every: float = T.HEARTBEAT_S):
        self.task, self.stale, self.every = task, stale, every
        self.token = f"{owner} {uuid.uuid4().hex}"
        self.path: Path | None = None
        self.ended = threading.Event()

    @classmethod
    def generations(cls, task: Path) -> list[int]:
        return sorted(int(p.name.rsplit(".", 1)[1]) for p in task.glob(f"{cls.NAME}.*"))

    def _at(self, generation: int) -> Path:
        return self.task / f"{self.NAME}.{generation}"

    def _fresh(self, generation: int) -> bool:
        """Whether that lock is still there and beats."""
        for place in (self._at(generation) / "owner", self._at(generation)):
            try:
                return datetime.now(UTC).timestamp() - place.stat().st_mtime < self.stale
            except FileNotFoundError:
                continue
        return False

    def seen(self) -> int | None:
        """The highest generation, which isn't held any more; None if there is none."""
        found = self.generations(self.task)
        if found and self._fresh(found[-1]):
            raise EngineError(f"{self._at(found[-1])} is held")
        return found[-1] if found else None

    def claim(self, seen: int | None) -> None:
        mine = (time.time_ns() if seen is None else seen) + 1
        try:
            self._at(mine).mkdir()
        except FileExistsError:
            raise EngineError(f"{self._at(mine)} was taken by another run") from None
        self.path = self._at(mine)
        try:
            self.beat()
        except FileNotFoundError:
            pass  # a later run cleared it
        if not self.mine():
            self.release()
            raise EngineError(f"a later run holds {self.task}")
        for old in self.generations(self.task):
            if old < mine:
                shutil.rmtree(self._at(old), ignore_errors=True)

    def __enter__(self) -> TaskLock:
        self.claim(self.seen())
        threading.Thread(target=self._beats, daemon=True).start()
        return self

    def _beats(self) -> None:
        while not self.ended.wait(self.every):
            if not self.mine():
                return
            os.utime(self.path / "owner")

    def fence(self) -> tuple[str, str]:
        """What held() needs to tell, anywhere the folder is seen, whether this run still holds the lock."""
        return str(self.path), self.token

    def mine(self) -> bool:
        return self.path is not None and held(*self.fence())

    def beat(self) -> None:
        """Writes the owner's file, whole at any moment."""
        part = self.path / f".{uuid.uuid4().hex}"
        part.write_text(self.token)
        part.replace(self.path / "owner")

    def release(self) -> None:
        try:
            if (self.path / "owner").read_text() == self.token:
                shutil.rmtree(self.path, ignore_errors=True)
        except FileNotFoundError:
            pass  # a later run cleared it

    def __exit__(self, *_: object) -> None:
        self.ended.set()
        self.release()


def held(path: str, token: str) -> bool:
    """Whether the lock directory still has this owner and no later one stands beside it."""
    lock = Path(path)
    try:
        return (lock / "owner").read_text() == token and TaskLock.generations(lock.parent)[-1:] == [int(lock.name.rsplit(".", 1)[1])]
    except FileNotFoundError:
        return False
