"""Tar shards: a source that reads large tars in ranges, pairs, a plain sink, and the read benchmark."""

from __future__ import annotations

import glob
import io
import json
import os
import tarfile
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "task string, shard string, key string, suffix string, seq long, size long, payload binary"


#: Bytes of a tar that a task reads, and payload bytes and members of an Arrow batch.
RANGE_BYTES, BATCH_BYTES, BATCH_ROWS = 128 << 20, 32 << 20, 1000
RANGE = "path string, begin long, finish long, seq long, tidy boolean"
MEMBER_TYPE = pa.schema([("task", pa.string()), ("shard", pa.string()), ("key", pa.string()), ("suffix", pa.string()), ("seq", pa.int64()), ("size", pa.int64()), ("payload", pa.binary())])
SAMPLE = "task string, shard string, key string, seq long, image binary, caption string, meta string"


def tar_paths(path: str | list[str]) -> list[str]:
    """Tars themselves, and those below folders."""
    given = [path] if isinstance(path, str) else path
    return [f for p in given for f in ([p] if os.path.isfile(p) else sorted(glob.glob(os.path.join(p, "**", "*.tar"), recursive=True)))]


def names_of(path: str) -> tuple[str, str]:
    """Task and shard of a tar, in either layout."""
    folder = os.path.dirname(path)
    folder = os.path.dirname(folder) if os.path.basename(folder) == "shards" else folder
    return os.path.basename(folder), os.path.basename(path)[:-4]


def member_ranges(path: str, range_bytes: int = RANGE_BYTES, first: int | None = None) -> list[tuple[int, int, int, bool]]:
    """(begin, finish, seq, tidy) of stretches of a tar, from headers alone: offsets, the place of the first member among all,
    and whether each key's members stand together in the tar. No stretch ends within a key; with `first`, the last one ends
    after so many keys."""
    cuts: list[tuple[int, int]] = []
    seen: set[str] = set()
    tidy, last, seq, end = True, None, 0, None
    with tarfile.open(path) as tar:
        for m in tar:
            if not m.isfile():
                continue
            key = m.name.partition(".")[0]
            if key != last:
                tidy &= key not in seen
                if first is not None and len(seen) == first and end is None:
                    end = m.offset
                seen.add(key)
                if not cuts or m.offset - cuts[-1][0] >= range_bytes:
                    cuts.append((m.offset, seq))
                last = key
            seq += 1
        end = tar.offset if end is None or not tidy else end  # members of scattered keys may be anywhere
    cuts = [c for c in cuts if c[0] < end]
    begins = [c[0] for c in cuts]
    return [(b, e, s, tidy) for (b, s), e in zip(cuts, [*begins[1:], end])]


def members_between(path: str, begin: int = 0, finish: int | None = None, seq: int = 0, payload: bool = True) -> Iterator[tuple]:
    """SCHEMA's rows of the members whose headers lie in a stretch."""
    task, shard = names_of(path)
    with open(path, "rb") as f:
        f.seek(begin)
        if begin == 0 and os.path.getsize(path) == 0:
            return
        with tarfile.open(fileobj=f, mode="r:") as tar:
            for m in tar:
                if finish is not None and m.offset >= finish:
                    return
                if m.isfile():
                    key, dot, suffix = m.name.partition(".")
                    yield task, shard, key, dot + suffix, seq, m.size, tar.extractfile(m).read() if payload else None
                    seq += 1


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = tar_paths(json.loads(options["paths"]) if "paths" in options else options["path"])
        self.payload = str(options.get("payload", "true")).lower() != "false"

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return batches_of(members_between(partition.value, payload=self.payload), MEMBER_TYPE)


class ShardTar(DataSource):
    """spark.read.format("shard_tar").load(path): one row per member, a partition for each tar.

    Options: payload=false reads headers only; paths is a JSON list of tars and folders. read_members() divides large tars.
    """

    @classmethod
    def name(cls) -> str:
        return "shard_tar"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options)


def tar_index(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, first: int | None = None) -> DataFrame:
    """RANGE's rows of the tars: one pass over their headers, in tasks. The ranges, not the tars, are then dealt to tasks."""
    paths = tar_paths(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("path").to_pylist():
                found = member_ranges(p, range_bytes, first)
                columns = list(zip(*found)) if found else [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(found), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["path", "begin", "finish", "seq", "tidy"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism)), "path")
    return listed.mapInArrow(run, RANGE)


def _dealt(ranges: DataFrame) -> DataFrame:
    """Each range is a task's share; AQE doesn't join such small rows again, as their number is asked for."""
    many = max(1, ranges.count())
    return ranges.repartition(many, "path", "begin")


def read_members(spark: SparkSession, path: str | list[str], payload: bool = True, first: int | None = None) -> DataFrame:
    """SCHEMA's rows of all members, or of those of each tar's first keys. Large tars are read in ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = members_between(r["path"], r["begin"], r["finish"], r["seq"], payload)
                yield from batches_of(_of_first(rows, None if first is None or r["tidy"] else first), MEMBER_TYPE)

    if first is None:
        return _dealt(tar_index(spark, path)).mapInArrow(run, SCHEMA)
    # with scattered keys only a pass from the begin tells which are the first
    return _dealt(tar_index(spark, path, 1 << 62, first)).mapInArrow(run, SCHEMA)


def _of_first(rows: Iterator[tuple], many: int | None) -> Iterator[tuple]:
    keys: set[str] = set()
    for row in rows:
        if many is not None and row[2] not in keys:
            if len(keys) == many:
                continue
            keys.add(row[2])
        yield row


def paired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """SAMPLE's rows of members whose keys stand together; of repeated suffixes the last."""
    for (task, shard, key), group in groupby(rows, key=lambda r: r[:3]):
        found: dict[str, bytes] = {}
        begin = None
        for _, _, _, suffix, seq, _, body in group:
            begin = seq if begin is None else begin
            found[suffix] = body
        text = lambda s: found[s].decode("utf-8", "replace") if s in found else None  # noqa: B023, E731
        yield task, shard, key, begin, found.get(".jpg"), text(".txt"), text(".json")


def read_samples(spark: SparkSession, path: str | list[str], first: int | None = None) -> DataFrame:
    """(task, shard, key, seq, image, caption, meta) of tars; of each tar's first keys with `first`.

    Pairs are formed where they are read, and nothing is shuffled after that, as a range ends before a key does. Only tars
    whose keys are scattered go through samples().
    """
    kinds = pa.schema([("task", pa.string()), ("shard", pa.string()), ("key", pa.string()), ("seq", pa.int64()), ("image", pa.binary()), ("caption", pa.string()), ("meta", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from batches_of(paired(members_between(r["path"], r["begin"], r["finish"], r["seq"])), kinds)

    ranges = tar_index(spark, path, first=first).cache()  # a row for each RANGE_BYTES; headers are walked once
    scattered = [r.path for r in ranges.where("NOT tidy").select("path").distinct().collect()]
    out = _dealt(ranges.where("tidy")).mapInArrow(run, SAMPLE)
    return out.unionByName(samples(read_members(spark, scattered, first=first), first)) if scattered else out


def samples(members: DataFrame, first: int | None = None) -> DataFrame:
    """(task, shard, key, image, caption, meta) of each key; the first N keys of a shard by member order.

    Members of a key may come from anywhere, so payloads are shuffled; read_samples() does without.
    """
    text = lambda s: F.make_valid_utf8(F.max_by("payload", F.when(F.col("suffix") == s, F.col("seq"))).cast("string"))
    if first is not None:  # before payloads are grouped
        keys = members.groupBy("task", "shard", "key").agg(F.min("seq").alias("from_"))
        keys = keys.withColumn("r_", F.row_number().over(Window.partitionBy("task", "shard").orderBy("from_"))).where(F.col("r_") <= first)
        members = members.join(keys.drop("r_", "from_"), ["task", "shard", "key"])
    return members.groupBy("task", "shard", "key").agg(F.min("seq").alias("seq"), F.max_by("payload", F.when(F.col("suffix") == ".jpg", F.col("seq"))).alias("image"), text(".txt").alias("caption"), text(".json").alias("meta"))


def write_shards(df: DataFrame, folder: str) -> DataFrame:
    """Writes rows (shard, key, suffix, payload) as tars in a shared folder, each under a temporary name first; (shard, members, bytes)."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        path = os.path.join(folder, f"{shard:05d}.tar")
        part = f"{path}.{os.getpid()}.partial"
        with tarfile.open(part, "w") as tar:
            for key, suffix, body in pdf.sort_values(["key", "suffix"])[["key", "suffix", "payload"]].itertuples(index=False):
                info = tarfile.TarInfo(key + suffix)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
        os.replace(part, path)
        return pd.DataFrame({"shard": [shard], "members": [len(pdf)], "bytes": [os.path.getsize(path)]})

    return df.select("shard", "key", "suffix", "payload").groupBy("shard").applyInPandas(write, "shard long, members long, bytes long")


def bench(spark: SparkSession, path: str) -> DataFrame:
    """Per tar: samples, decode_failures, bytes_read and seconds, timed where it is read; no codec means headers are checked."""
    files = sorted(glob.glob(os.path.join(path, "**", "*.tar"), recursive=True)) or [path]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for pdf in batches:
            out = []
            for name in pdf["path"]:
                began, good, bad, size = time.monotonic(), 0, 0, 0
                with tarfile.open(name) as tar:
                    for m in tar:
                        if m.isfile() and m.name.endswith(".jpg"):
                            body = tar.extractfile(m).read()
                            size += len(body)
                            ok = decodes(body)
                            good, bad = good + ok, bad + (not ok)
                out.append((name, good, bad, size, time.monotonic() - began))
            yield pd.DataFrame(out, columns=["path", "samples", "decode_failures", "bytes_read", "elapsed_sec"])

    rows = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, len(files)))
    return rows.mapInPandas(run, "path string, samples long, decode_failures long, bytes_read long, elapsed_sec double")


def bench_total(results: DataFrame) -> DataFrame:
    """Counts and seconds summed, then rates; NULL where nothing was timed."""
    got = results.agg(*(F.sum(c).alias(c) for c in ("samples", "decode_failures", "bytes_read", "elapsed_sec")))
    timed = F.when(F.col("elapsed_sec") > 0, F.col("elapsed_sec"))
    tried = F.col("samples") + F.col("decode_failures")
    return got.select("*", tried.alias("attempted"), (F.col("samples") / timed).alias("samples_per_sec"), (F.col("bytes_read") / timed).alias("bytes_per_sec"), F.try_divide(F.col("decode_failures").cast("double"), tried).alias("failure_rate"))


def decodes(body: bytes) -> bool:
    """Whether an image codec decodes the bytes; without a codec, whether they are framed like a picture."""
    try:
        from PIL import Image
    except ImportError:
        return (body[:3] == b"\xff\xd8\xff" and body.rstrip(b"\0").endswith(b"\xff\xd9")) or (body[:8] == b"\x89PNG\r\n\x1a\n" and b"IEND" in body[-16:])
    try:
        Image.open(io.BytesIO(body)).convert("RGB")
        return True
    except Exception:  # noqa: BLE001  a failure is counted
        return False
