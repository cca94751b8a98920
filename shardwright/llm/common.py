"""Helpers that the operators of this package share: input columns, text buffers, durable intermediates."""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows turned into Python objects at a time.
SLICE_ROWS = 256
#: Rows of 64 bits, at most, of the table that amid() broadcasts; a power of two.
WORDS = 1 << 18


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the id, the text (null: empty) and what is asked for besides, so no other column's name can clash.

    What an Arrow batch may hold is the session's (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set).
    """
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more
    )


def columns(df: DataFrame) -> list[Column]:
    """All columns of df, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def amid(df: DataFrame, key: str, keys: DataFrame, of: str, how: str = "left_semi") -> DataFrame:
    """Rows of df whose hash `key` may be among the hashes `of` of keys; with how="left_anti", those whose key surely isn't.

    The hashes are marked in a table of bits, whose size is bounded and which is broadcast: df isn't shuffled. Some other
    keys share a bit, so an exact join follows where it matters.
    """
    word, bits = fresh(df, "word", "bits")
    place = lambda c: (F.col(c).bitwiseAND(F.lit(WORDS - 1)), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{c}`, 48) & 63 AS int))"))
    (at, bit), (at_of, bit_of) = place(key), place(of)
    marks = keys.select(at_of.alias(word), bit_of.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    return df.join(F.broadcast(marks), (at == F.col(word)) & (bit.bitwiseAND(F.col(bits)) != 0), how)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see. A temporary one is set only on a local master; elsewhere the cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.getCheckpointDir() is None:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shardwright-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


_WRITTEN: dict[str, SparkSession] = {}


def _delete(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is not None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def _clean() -> None:
    for path in list(_WRITTEN):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is the cluster's to clean
            return


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there, and a lost executor costs nothing.

    It stays until dropped() or the end of the process.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_clean)
    _WRITTEN[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes what written() wrote for these, once nothing reads them any more."""
    for df in tables:
        if df is not None and (path := getattr(df, "_written_at", None)):
            _delete(path)


#: What this worker remembers from one task to the next: of one operator at a time.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """A worker's memory of that name. Another operator's goes first, so stages that share workers don't add up."""
    if name not in _KEPT:
        forget()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Gives back what the worker remembers, and memory that its allocators hold on to."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another libc
        pass


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[list]]:
    """The named columns as lists, SLICE_ROWS rows at a time; binary and text columns as they are."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield [part.column(n).to_pylist() for n in names]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text or binary column as its bytes and its offsets, both without copying the bytes."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def single_spaced(data: bytes) -> bytes:
    """Each run of the bytes 0x20 and 0x09 to 0x0D becomes one space."""
    if not data:
        return data
    lead = b" " if data[0] == 32 or 9 <= data[0] <= 13 else b""
    words = data.split()
    if not words:
        return b" "
    tail = b" " if data[-1] == 32 or 9 <= data[-1] <= 13 else b""
    return lead + b" ".join(words) + tail
