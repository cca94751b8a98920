"""A sink for shards: tar, parquet and statistics of each, all there or none."""

from __future__ import annotations

import io
import json
import os
import shutil
import struct
import tarfile
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..errors import EngineError
from .sinks import held

ATTEMPTS = ".attempts"
#: In the order in which they are moved: statistics last, as they say that a shard is finished.
SUFFIXES = (".tar", ".parquet", "_stats.json")
SIDECAR = ("key", "url", "caption", "status", "width", "height", "original_width", "original_height", "sha256")


def picture_size(body: bytes) -> tuple[int, int] | None:
    """Width and height as a PNG, GIF or JPEG header says."""
    if body[:8] == b"\x89PNG\r\n\x1a\n" and len(body) >= 24:
        return struct.unpack(">II", body[16:24])
    if body[:6] in (b"GIF87a", b"GIF89a") and len(body) >= 10:
        return struct.unpack("<HH", body[6:10])
    at = 2 if body[:2] == b"\xff\xd8" else len(body)
    while at + 9 <= len(body) and body[at] == 0xFF:
        kind, size = body[at + 1], int.from_bytes(body[at + 2 : at + 4], "big")
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", body[at + 5 : at + 9])
            return width, height
        at += 2 + size
    return None


@dataclass
class Written(WriterCommitMessage):
    """Stems of the finished shards, below a task attempt's own folder."""

    folder: str
    stems: list[str] = field(default_factory=list)


class _Shard:
    """The three files of one shard, written row by row."""

    def __init__(self, stem: str, schema: pa.Schema):
        os.makedirs(os.path.dirname(stem), exist_ok=True)
        self.stem, self.schema = stem, schema
        self.tar, self.table = tarfile.open(f"{stem}.tar", "w"), pq.ParquetWriter(f"{stem}.parquet", schema)
        self.rows: list[dict] = []
        self.outcomes: Counter[str] = Counter()

    def add(self, row: dict) -> None:
        body = row.pop("payload")
        size = picture_size(body) if body is not None else None
        for name, value in zip(("width", "height"), size or (None, None)):
            for column in (name, f"original_{name}"):  # nothing is resized
                if row.get(column) is None:
                    row[column] = value
        self.outcomes["success" if row["status"] == "success" else row.get("error_message") or row["status"]] += 1
        if row["status"] == "success":
            said = {k: row[k] for k in SIDECAR if k in row}
            for suffix, data in ((".jpg", body), (".txt", (row.get("caption") or "").encode() if row.get("caption") is not None else None), (".json", json.dumps(said).encode())):
                if data is not None:
                    info = tarfile.TarInfo(row["key"] + suffix)
                    info.size = len(data)
                    self.tar.addfile(info, io.BytesIO(data))
        self.rows.append(row)
        if len(self.rows) == 1000:
            self._flush()

    def _flush(self) -> None:
        self.table.write_table(pa.Table.from_pylist(self.rows, schema=self.schema))
        self.rows.clear()

    def close(self) -> None:
        self._flush()
        self.tar.close()
        self.table.close()
        good, count = self.outcomes["success"], sum(self.outcomes.values())
        self.outcomes = Counter({m: n for m, n in self.outcomes.items() if n})
        with open(f"{self.stem}_stats.json", "w") as f:
            json.dump({"count": count, "successes": good, "failed_to_download": count - good, "failed_to_resize": 0, "status_dict": dict(sorted(self.outcomes.items()))}, f)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, names: list[str]):
        self.root = options["path"]
        self.fences = [tuple(x) for x in json.loads(options.get("fences", "[]"))]
        self.job = os.path.join(self.root, ATTEMPTS, uuid.uuid4().hex)
        missing = {"task", "shard", "key", "status", "payload"}.difference(names)
        if missing:
            raise EngineError(f"shards need the columns {sorted(missing)}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Rows in the order of task, shard and key; each attempt of a task writes into a folder of its own."""
        done, shard, now = Written(os.path.join(self.job, uuid.uuid4().hex)), None, None
        for batch in batches:
            kinds = {f.name: f.type for f in batch.schema if f.name not in ("task", "shard", "payload")}
            kinds |= {c: pa.int64() for c in ("width", "height", "original_width", "original_height")}
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    stem = os.path.join(f"task-{row.pop('task'):06d}", "shards", f"{row.pop('shard'):05d}")
                    if stem != now:
                        if shard is not None:
                            shard.close()
                        if stem in done.stems:
                            raise EngineError(f"the rows of {stem} aren't together")
                        shard, now = _Shard(os.path.join(done.folder, stem), pa.schema(list(kinds.items()))), stem
                        done.stems.append(stem)
                    shard.add(row)
        if shard is not None:
            shard.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        """Moves what the successful attempts wrote; a run that lost a task's lock moves nothing."""
        lost = [path for path, token in self.fences if not held(path, token)]
        if lost:
            self.abort(messages)
            raise EngineError(f"{lost[0]} isn't held any more")
        for message in messages:
            for stem in message.stems if message else ():
                target = os.path.join(self.root, stem)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                for suffix in reversed(SUFFIXES):  # a shard that is written anew first stops being finished
                    if os.path.exists(target + suffix):
                        os.remove(target + suffix)
                for suffix in SUFFIXES:
                    os.replace(os.path.join(message.folder, stem) + suffix, target + suffix)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Everything below the job's folder goes, what failed attempts left included."""
        shutil.rmtree(self.job, ignore_errors=True)
        try:
            os.rmdir(os.path.dirname(self.job))
        except OSError:
            pass  # another job's attempts


class Shards(DataSource):
    """df.write.format("shards").mode("append").save(root): task-NNNNNN/shards/NNNNN.tar, .parquet and _stats.json.

    Columns: task, shard, key, status, payload, and what else the parquet files shall hold. A partition holds whole
    shards, its rows sorted by task, shard and key; write_shards() sees to that. Option fences: a JSON list of what
    TaskLock.fence() gives.
    """

    @classmethod
    def name(cls) -> str:
        return "shards"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:  # noqa: ANN001
        if overwrite:
            raise EngineError("shards are added to a tree, or replaced one by one; mode append")
        return _Writer(self.options, schema.names)


def write_shards(rows: DataFrame, root: str, fences: list[tuple[str, str]] = ()) -> None:
    """All shards of the rows, or none. The same rows give the same bytes, however they are dealt."""
    rows.sparkSession.dataSource.register(Shards)
    whole = rows.repartition("task", "shard").sortWithinPartitions("task", "shard", "key")
    whole.write.format("shards").mode("append").option("fences", json.dumps([list(f) for f in fences])).save(root)
